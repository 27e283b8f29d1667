"""Language-model scoring with a log-frequency Bloom filter.

Tokens are hashed words (runs of visible characters, A-Z lower-cased) and one end token a text. The filter holds, for
every bigram, unigram and context of the training texts, its count on a logarithmic scale: an n-gram whose quantised
count is q is inserted q times, as (n-gram, 1) to (n-gram, q). A count is read by probing (n-gram, 1), (n-gram, 2), ...
until one is missing (Talbot and Osborne 2007), so an error can only overstate a rare n-gram, never lose a frequent one.
Probabilities interpolate the bigram with the unigram estimate.

Counting: tasks sum up token hashes with numpy and send packed blocks, one row for each (kind, block) and flush. A block
holds the n-grams of one hash range; the number of blocks follows the corpus, so a block fits a task at any size, and no
n-gram is hot, because every task sends it once a flush.

The filter goes to every worker. Its size is bounded by ``MAX_NGRAMS``: where the insertions of all n-grams are more, it
holds those of the larger quantised counts only. No n-gram is left out: what the filter does not hold is sent, by batch of
texts, to the block of its hash, meets its exact count there, and comes back as one quantised byte. The tokens of the batch
wait as two bytes each (quantised unigram and bigram, 0 where open), so the texts themselves do not move.

The exact unigram score (``base_score``) needs exact counts of all tokens, more than can be broadcast. Tokens that make up
one in ``FREQUENT`` of the corpus or more are at most ``FREQUENT``; they are summed where the text is. All others are sent
to the block of their hash, meet their counts there, and come back as one partial sum for each text and block.

Defined cases: a NULL text is empty and consists of the end token alone; rows without an id are scored but never learned
from; without any training token N and V are 0 and every count is 0; repeated rows are each counted and scored; empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import held_out, in_arrow, ship_package, stored, table
from riskloom.llm.vectors import VISIBLE, Slice, mix, slices, word_hashes, words

#: The n-grams of each order that the filter is made for, and insertions it has room for per such n-gram, over both orders
#: (2.6 * 2**27 insertions of 10 bits are 436 MB). Rarer n-grams than fit are left to the blocks.
MAX_NGRAMS, INSERTIONS = 1 << 27, 2.6
#: Tokens with at least one in this many occurrences are counted in place.
FREQUENT = 1 << 17
#: Base of the quantised counts, bits and probes for each insertion.
BASE, BITS, PROBES = 2.0, 10, 5
BIGRAM_WEIGHT = 0.6
#: Training tokens that one block of n-grams is made for.
TOKENS_PER_BLOCK = 2_000_000
BYTES_PER_TOKEN = 6
#: Tokens that a task sums up before it sends them on.
FLUSH = 2_000_000

_U = np.uint64
END = mix(np.array([0x5EED], np.uint64))[0]
UNIGRAM, BIGRAM = 0, 1
_LAST = _U(0xFFFFFFFFFFFFFFFF)
#: What a row between the stages is: a text, the exact counts its tokens ask for, the open n-grams of a batch by order, and
#: the tokens of a batch that wait for them.
TEXT, EXACT, OPEN, WAITING = 0, 1, (2, 3), 4


def tokens(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the rows of a slice, each closed by END, and their bounds by row."""
    found = words(part, VISIBLE)
    hashes = word_hashes(part.data, found.starts, found.ends)
    bounds = found.bounds + np.arange(part.rows + 1)
    out = np.full(len(hashes) + part.rows, END)
    out[np.arange(len(hashes)) + found.rows()] = np.minimum(hashes, _LAST - _U(1))
    return out, bounds


def bigrams(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every token the hash of (token before, token); a text begins after an END."""
    before = np.concatenate([[END], hashes[:-1]])
    before[bounds[:-1]] = END
    with np.errstate(over="ignore"):
        return mix(before * _U(0x9E3779B97F4A7C15) + hashes)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def block_bounds(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Where each block begins in sorted keys; blocks are equal ranges of the hash."""
    edges = np.array([(b << 64) // blocks for b in range(1, blocks)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _packed(kind: int, keys: np.ndarray, counts: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    at = block_bounds(keys, blocks)
    some = np.flatnonzero(np.diff(at))
    small = counts.astype("<u4")  # of one flush, so below its number of tokens and those of one slice
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(some), kind, np.int32)),
            pa.array(some.astype(np.int32)),
            pa.array([keys[at[b] : at[b + 1]].tobytes() for b in some], pa.binary()),
            pa.array([small[at[b] : at[b + 1]].tobytes() for b in some], pa.binary()),
        ],
        ["kind", "block", "keys", "counts"],
    )


def _count(batches, blocks: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        if held:
            for kind in (UNIGRAM, BIGRAM):
                keys, counts = summed(np.concatenate([h[kind] for h in held]))
                yield from _packed(kind, keys, counts, blocks)
            held.clear()

    for batch in batches:
        for part in slices(batch.column("text")):
            hashes, bounds = tokens(part)
            held.append((hashes, bigrams(hashes, bounds)))
            size += len(hashes)
            if size >= FLUSH:
                yield from flush()
                size = 0
    yield from flush()


_COUNTED = "kind int, block int, keys binary, counts binary"


def _merge(table_: pa.Table) -> pa.Table:
    """One block: all its parts summed, with what the driver has to know of it."""
    kind, block = table_.column("kind")[0].as_py(), table_.column("block")[0].as_py()
    keys = np.frombuffer(b"".join(table_.column("keys").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(table_.column("counts").to_pylist()), "<u4").astype(np.int64)
    keys, counts = summed(keys, counts)
    return pa.table(
        {
            "kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int32()),
            "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([counts.astype("<i8").tobytes()], pa.binary()),
            "distinct": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64()),
        }
    )


_MERGED = "kind int, block int, keys binary, counts binary, distinct long, total long"


def count_ngrams(texts: DataFrame, blocks: int) -> DataFrame:
    """Exact counts of unigrams and bigrams, one row for each kind and block, stored."""
    ship_package(texts.sparkSession)
    parts = in_arrow(texts.select("text"), _count, _COUNTED, blocks)
    return stored(parts.groupBy("kind", "block").applyInArrow(_merge, _MERGED))


# The filter


def quantised(counts: np.ndarray) -> np.ndarray:
    """1, 2, 3, ... for counts from 1, BASE, BASE**2, ..."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-12).astype(np.int64)


def expected(q: np.ndarray) -> np.ndarray:
    """The count that a quantised one stands for: the middle of its range, 0 for 0."""
    low = BASE ** (np.maximum(q, 1) - 1)
    return np.where(q > 0, (low + np.maximum(low * BASE - 1, low)) / 2, 0.0)


def _positions(keys: np.ndarray, level: np.ndarray, bits: np.ndarray) -> Iterator[np.ndarray]:
    """Bit positions of (key, level) in a filter of that many bits, one array for each probe."""
    with np.errstate(over="ignore"):
        a = mix(keys + level.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
        b = mix(a ^ _U(0xA0761D6478BD642F)) | _U(1)
        for i in range(PROBES):
            yield (((a + _U(i) * b) >> _U(32)) * bits.astype(np.uint64)) >> _U(32)


def _build(batches, least: int) -> Iterator[pa.RecordBatch]:
    """(kind, block, bits, filter) of each block of counts, for quantised counts from ``least`` on."""
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.frombuffer(row["keys"], np.uint64)
            counts = np.frombuffer(row["counts"], "<i8")
            q = quantised(counts)
            keys, q = keys[q >= least], q[q >= least]
            size = max(64, -(-int(q.sum()) * BITS // 8) * 8)
            filled = np.zeros(size, bool)
            for level in range(1, int(q.max(initial=0)) + 1):
                own = keys[q >= level]
                for at in _positions(own, np.full(len(own), level), np.full(len(own), size)):
                    filled[at.astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["kind"]], pa.int32()), pa.array([row["block"]], pa.int32()),
                 pa.array([size], pa.int64()), pa.array([np.packbits(filled).tobytes()], pa.binary())],
                ["kind", "block", "bits", "filter"],
            )


def log10_of(own: np.ndarray, pair: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 of the probability of every token after the one before it, from quantised counts of tokens and pairs."""
    own, pair = expected(own), expected(pair)
    # Every text ends in END and begins after one, so counts of contexts are those of tokens, one place on.
    context = np.concatenate([own[-1:], own[:-1]])
    alone = np.minimum((own + 0.5) / (total + 0.5 * (distinct + 1)), 1.0)
    pair = np.minimum(pair, context)
    weight = np.where(context > 0, BIGRAM_WEIGHT, 0.0)
    return np.log10(weight * pair / np.maximum(context, 1) + (1 - weight) * alone)


class Model:
    """The filter, in one array of bytes, with the exact counts of the most frequent tokens.

    It holds n-grams from the quantised count ``level`` on; at level 1 these are all.
    """

    def __init__(
        self, filters: dict[tuple[int, int], tuple[int, bytes]], blocks: int, total: int, distinct: int, level: int = 1
    ) -> None:
        self.blocks, self.total, self.distinct, self.level = blocks, total, distinct, level
        size = np.array([[filters.get((k, b), (0, b""))[0] for b in range(blocks)] for k in (UNIGRAM, BIGRAM)], np.int64)
        data = [filters[k, b][1] for k in (UNIGRAM, BIGRAM) for b in range(blocks) if (k, b) in filters]
        self.bits = np.maximum(size, 1)
        self.begin = np.concatenate([[0], np.cumsum(size.ravel())])[:-1].reshape(size.shape)
        self.present = size > 0
        self.data = np.frombuffer(b"".join(data) or b"\0", np.uint8)
        # Frequent tokens in order; a last key that no token has ends the search.
        self.frequent_keys, self.frequent_counts = np.array([_LAST]), np.zeros(1, np.int64)

    def _holds(self, kind: int, keys: np.ndarray, level: int) -> np.ndarray:
        block = ((keys >> _U(32)) * _U(self.blocks) >> _U(32)).astype(np.int64)
        found = self.present[kind, block].copy()
        size, begin = self.bits[kind, block], self.begin[kind, block]
        for at in _positions(keys, np.full(len(keys), level), size):
            where = begin + at.astype(np.int64)
            where[~found] = 0
            found &= (self.data[where >> 3] >> (7 - (where & 7)).astype(np.uint8)) & 1 == 1
        return found

    def counts(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """Quantised counts by repeated probes; 0 where the filter does not hold the n-gram."""
        distinct, back = np.unique(keys, return_inverse=True)
        q = np.zeros(len(distinct), np.uint8)
        open_ = np.arange(len(distinct))
        level = 0
        while len(open_):
            level += 1
            open_ = open_[self._holds(kind, distinct[open_], level)]
            q[open_] = level
        q[q < self.level] = 0  # nothing so rare was inserted
        return q[back]


def held_level(counts: DataFrame, total: int, max_ngrams: int) -> int:
    """The least quantised count that the filter holds: 1, or as many as its insertions need to stay within their bound."""
    if total <= max_ngrams:  # an n-gram is inserted at most as often as it occurs
        return 1
    found = in_arrow(counts.select("counts"), _insertions, "q int, n long").groupBy("q").agg(F.sum("n").alias("n")).collect()
    level, held = 1, sum(r["n"] for r in found)
    for r in sorted(found, key=lambda r: r["q"]):
        if held <= INSERTIONS * max_ngrams:
            break
        level, held = r["q"] + 1, held - r["n"]
    return level


def _insertions(batches) -> Iterator[pa.RecordBatch]:
    """(q, n): how many insertions the n-grams of each quantised count take."""
    for batch in batches:
        for counts in batch.column("counts").to_pylist():
            n = np.bincount(quantised(np.frombuffer(counts, "<i8")))
            q = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(q * n[q])], ["q", "n"])


def build_model(counts: DataFrame, blocks: int, max_ngrams: int = MAX_NGRAMS) -> Model:
    """The model from stored counts. The driver receives the filter, which is bounded, and the frequent tokens."""
    totals = counts.groupBy("kind").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).collect()
    size = {r["kind"]: (r["total"], r["distinct"]) for r in totals}
    total, distinct = size.get(UNIGRAM, (0, 0))
    level = held_level(counts, total, max_ngrams)
    built = in_arrow(
        counts.select("kind", "block", "keys", "counts"), _build, "kind int, block int, bits long, filter binary", level
    )
    filters = {(r["kind"], r["block"]): (r["bits"], bytes(r["filter"])) for r in built.toLocalIterator()}
    model = Model(filters, blocks, total, distinct, level)
    often = in_arrow(
        counts.where(F.col("kind") == UNIGRAM).select("keys", "counts"),
        _frequent,
        "key long, n long",
        max(1, math.ceil(total / FREQUENT)),
    ).toArrow()
    keys = often.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    model.frequent_keys = np.append(keys[order], _LAST)
    model.frequent_counts = np.append(often.column("n").to_numpy()[order], 0)
    return model


def _frequent(batches, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            keys, counts = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["counts"], "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[counts >= least]), pa.array(counts[counts >= least])], ["key", "n"]
            )


# Scoring


def _asked(hashes: np.ndarray, owners: np.ndarray, blocks: int) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """Which blocks the hashes ask, and for each of them its hashes in order, with their owners, if any, as bytes."""
    order = np.argsort(hashes)
    hashes, owners = hashes[order], owners[order].astype("<u4") if len(owners) else owners
    at = block_bounds(hashes, blocks)
    some = np.flatnonzero(np.diff(at))
    return (
        some.astype(np.int32),
        [hashes[at[i] : at[i + 1]].tobytes() for i in some],
        [owners[at[i] : at[i + 1]].tobytes() for i in some],
    )


def _packed_rows(first: int, what: int, blocks: np.ndarray, keys: list[bytes], owners: list[bytes]) -> pa.RecordBatch:
    n = len(blocks)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(blocks, pa.int32()), pa.array(np.full(n, first)), pa.array(np.full(n, what, np.int32)),
            *(pa.nulls(n, t) for t in _TYPES[3:10]), pa.array(keys, pa.binary()), pa.array(owners, pa.binary()),
        ],
        _NAMES,
    )


def _score(batches, shared) -> Iterator[pa.RecordBatch]:
    """What is known of every row, and for every block the rarer tokens of these rows, as packed (token, row) pairs.

    Where the filter leaves n-grams open, the score of a batch waits: its quantised counts go along, with the place of each
    open one among the distinct open ones, which are asked for in the order of their hashes.
    """
    model: Model = shared.value
    log = lambda c: np.log10((c + 0.5) / (model.total + 0.5 * (model.distinct + 1)))
    for batch in batches:
        rows = batch.column("_row").to_numpy()
        whole: list[tuple] = []
        asked: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[tuple[np.ndarray, ...]] = []
        for part in slices(batch.column("text")):
            hashes, bounds = tokens(part)
            at = np.searchsorted(model.frequent_keys, hashes)
            count = model.frequent_counts[at]
            known = model.frequent_keys[at] == hashes
            add = lambda values: np.add.reduceat(values, bounds[:-1])  # noqa: E731, B023
            pairs = bigrams(hashes, bounds)
            own, pair = model.counts(UNIGRAM, hashes), model.counts(BIGRAM, pairs)
            if model.level > 1:
                waiting.append((own, pair, hashes[own == 0], pairs[pair == 0]))
                score_ = np.zeros(part.rows)
            else:
                score_ = add(log10_of(own, pair, model.total, model.distinct))
            whole.append(
                (np.diff(bounds), add(known.astype(np.int64)), add(np.where(known, log(count), 0.0)), score_)
            )
            owner = np.repeat(np.arange(part.first, part.first + part.rows), np.diff(bounds))
            asked.append((hashes[~known], owner[~known]))
        if not whole:
            continue
        n, k, b, s = (pa.array(np.concatenate(c)) for c in zip(*whole))
        none = pa.nulls(len(rows), pa.binary())
        block = pa.array((rows % model.blocks).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [block, pa.array(np.full(len(rows), rows[0])), pa.array(np.full(len(rows), TEXT, np.int32)), batch.column("_row"),
             batch.column("doc_id"), batch.column("held_out"), n, k, b, s, none, none],
            _NAMES,
        )
        # Row numbers inside a partition follow one another, so the first one of the batch is enough.
        yield _packed_rows(rows[0], EXACT, *_asked(*(np.concatenate(c) for c in zip(*asked)), model.blocks))
        if waiting:
            own, pair, *open_ = (np.concatenate(c) for c in zip(*waiting))
            places = []
            for what, hashes in zip(OPEN, open_):
                distinct, back = np.unique(hashes, return_inverse=True)
                yield _packed_rows(rows[0], what, *_asked(distinct, np.zeros(0, "<u4"), model.blocks))
                places.append(back.astype("<u4").tobytes())
            home = (mix(rows[:1].astype(np.uint64)) % _U(model.blocks)).astype(np.int32)
            yield _packed_rows(rows[0], WAITING, home, [own.tobytes() + pair.tobytes()], [b"".join(places)])


_PARTIAL = (
    ("block", "int", pa.int32()), ("_batch", "long", pa.int64()), ("what", "int", pa.int32()), ("_row", "long", pa.int64()),
    ("doc_id", "long", pa.int64()), ("held_out", "boolean", pa.bool_()), ("n_tokens", "long", pa.int64()),
    ("n_known", "long", pa.int64()), ("base_score", "double", pa.float64()), ("score", "double", pa.float64()),
    ("keys", "binary", pa.binary()), ("owners", "binary", pa.binary()),
)
_NAMES, _TYPES = [c[0] for c in _PARTIAL], [c[2] for c in _PARTIAL]
_ANSWER = ", ".join(f"{c} {t}" for c, t, _ in _PARTIAL)
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _answer(total: int, distinct: int, asked: pa.Table, counts: pa.Table) -> pa.Table:
    """The rows of one block as they came; questions come back as packed (n_known, base_score) of their rows, or as the
    quantised counts of open n-grams."""
    exact = {}
    for kind in (UNIGRAM, BIGRAM):
        own = counts.filter(pc.equal(counts.column("kind"), kind))
        exact[kind] = (
            np.frombuffer(b"".join(own.column("keys").to_pylist()), np.uint64),
            np.frombuffer(b"".join(own.column("counts").to_pylist()), "<i8"),
        )

    def count_of(kind: int, hashes: np.ndarray) -> np.ndarray:
        keys, known = exact[kind]
        if not len(keys):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, known[at], 0)

    out = [asked.filter(pc.is_in(asked.column("what"), pa.array([TEXT, WAITING], pa.int32())))]
    at = asked.schema.get_field_index("keys")
    for what, kind in ((EXACT, UNIGRAM), *zip(OPEN, (UNIGRAM, BIGRAM))):
        questions = asked.filter(pc.equal(asked.column("what"), what))
        answers, owners_of = [], []
        for hashes, owners in zip(questions.column("keys").to_pylist(), questions.column("owners").to_pylist()):
            c = count_of(kind, np.frombuffer(hashes, np.uint64))
            if what != EXACT:
                answers.append(np.where(c > 0, quantised(c), 0).astype(np.uint8).tobytes())
                owners_of.append(b"")
                continue
            own, back = np.unique(np.frombuffer(owners, "<u4"), return_inverse=True)
            logs = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            sums = np.stack([np.bincount(back, c > 0, minlength=len(own)), np.bincount(back, logs, minlength=len(own))])
            answers.append(sums.astype("<f8").tobytes())
            owners_of.append(own.astype("<u4").tobytes())
        packed = questions.set_column(at, "keys", pa.array(answers, pa.binary()))
        packed = packed.set_column(at + 1, "owners", pa.array(owners_of, pa.binary()))
        out.append(packed.cast(asked.schema))
    return pa.concat_tables(out)


def _filled(table_: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Quantised counts (tokens, pairs) of a batch that waited, with the answers of all blocks in the open places."""
    row = table_.filter(pc.equal(table_.column("what"), WAITING)).to_pylist()[0]
    counts = np.frombuffer(row["keys"], np.uint8).reshape(2, -1).copy()
    places = np.frombuffer(row["owners"], "<u4")
    for own, what in zip(counts, OPEN):
        answers = table_.filter(pc.equal(table_.column("what"), what)).sort_by("block")
        found = np.frombuffer(b"".join(answers.column("keys").to_pylist()), np.uint8)
        holes = np.flatnonzero(own == 0)
        own[holes] = found[places[: len(holes)]]
        places = places[len(holes) :]
    return counts[0], counts[1]


def _total(total: int, distinct: int, table_: pa.Table) -> pa.Table:
    """One result a row of one batch: what was known at once, and the answers of all blocks."""
    rows = table_.filter(pc.equal(table_.column("what"), TEXT))
    packed = table_.filter(pc.equal(table_.column("what"), EXACT))
    place = rows.column("_row").to_numpy() - table_.column("_batch")[0].as_py()
    n_known, base = np.zeros(len(place), np.int64), np.zeros(len(place))
    where = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
    where[place] = np.arange(len(place))
    for sums, owners in zip(packed.column("keys").to_pylist(), packed.column("owners").to_pylist()):
        at = where[np.frombuffer(owners, "<u4")]
        found = np.frombuffer(sums, "<f8").reshape(2, -1)
        n_known[at] += found[0].astype(np.int64)
        base[at] += found[1]
    n_known += rows.column("n_known").to_numpy()
    base += rows.column("base_score").to_numpy()
    score_ = rows.column("score")
    if pc.any(pc.equal(table_.column("what"), WAITING)).as_py():
        logs = log10_of(*_filled(table_), total, distinct)
        sizes = rows.column("n_tokens").to_numpy()[where]  # of the texts in the order of their tokens
        sums = np.add.reduceat(logs, np.cumsum(sizes) - sizes)
        score_ = pa.array(sums[place])
    return pa.table(
        [rows.column("doc_id"), rows.column("held_out"), rows.column("n_tokens"), pa.array(n_known), pa.array(base), score_],
        [c.split()[0] for c in _RESULT.split(", ")],
    )


def _answering(total: int, distinct: int):
    def answer(asked: pa.Table, counts: pa.Table) -> pa.Table:
        return _answer(total, distinct, asked, counts)

    return answer


def _totalling(total: int, distinct: int):
    def total_of(table_: pa.Table) -> pa.Table:
        return _total(total, distinct, table_)

    return total_of


def score(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for rows (doc_id, held_out, text).

    Rows and answers meet again by the Arrow batch that they came from, which is bounded in size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long"), "held_out", "text"
    )
    partial = in_arrow(rows, _score, _ANSWER, shared)
    # Pairs are asked for only where the filter leaves some open.
    exact = (counts if model.level > 1 else counts.where(F.col("kind") == UNIGRAM)).select("kind", "block", "keys", "counts")
    answered = (
        partial.groupBy("block")
        .cogroup(exact.groupBy("block"))
        .applyInArrow(_answering(model.total, model.distinct), _ANSWER)
    )
    done = answered.groupBy("_batch").applyInArrow(_totalling(model.total, model.distinct), _RESULT)
    return done.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score",
        "score",
    )


def learn(texts: DataFrame, tokens_per_block: int = TOKENS_PER_BLOCK, max_ngrams: int = MAX_NGRAMS) -> tuple[DataFrame, Model]:
    """Stored n-gram counts of all texts, and the model made from them."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BYTES_PER_TOKEN / tokens_per_block))
    counts = count_ngrams(texts, blocks)
    return counts, build_model(counts, blocks, max_ngrams)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 5, 1))
    counts, model = learn(docs.where(~F.col("held_out")))
    return score(docs, counts, model)
