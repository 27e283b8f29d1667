"""Token counts of a byte-level BPE tokenizer, by two deterministic transducers. No token is ever written.

The first one reads characters and marks where the tokenizer cuts a text before merging (``splitter``). It has eight
states, so what a chunk of text does is a map from eight states to eight states. All such maps form a small monoid. Chunks
of ``CHUNK`` characters are mapped side by side, a parallel prefix scan over the composition table gives the state that
each chunk starts in, and a second pass marks the cuts. No step depends on how long a text is.

The second one reads the bytes of a piece (``Counter``). Its transitions are annotated with the change of the number of
tokens that the bytes read so far encode to: +1 for a byte that starts a token of its own, 0 or less where tokens merge.
A state holds what later bytes can depend on: the suffixes that begin some token, with the last token before each and the
count there. States are compiled when they are first met and stay with the worker; all pieces of a slice of text walk
the same table in step. A piece always starts in the same state, so counts of pieces need nothing but adding up.

Which token comes last follows from pairs alone: of all tokens that a prefix ends with, exactly one stays apart from the
last token of the rest, that is, no merge across their border comes before the merges on both sides of it.

Defined cases: a NULL text is empty and has 0 bytes and 0 tokens; strings of special tokens inside a text count as one
token, as in the library; repeated rows are each counted; empty tables give no rows; further columns are ignored. Texts of
any length are read whole. Vocabularies with a normaliser, byte fallback or other cuts than the byte-level ones are refused.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import hold, in_arrow, table
from riskloom.llm.vectors import Slice, slices

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Characters of a chunk; compiled states, and pairs of tokens, that a worker holds before it starts anew.
CHUNK, STATES_HELD, PAIRS_HELD = 128, 150_000, 1_000_000
#: Pieces that are still being read when the rest of each is read by itself.
FEW = 12

# The splitter: letters, numbers, other visible characters and white space. Fixed by the tokenizer's cuts:
# 's 't 'm 'd 're 've 'll at the start of a piece; an optional space and a run of one kind; runs of white space, without
# the last one where something visible follows.
LETTER, NUMBER, OTHER, WHITE, SPACE, QUOTE, UNKNOWN = 0, 1, 2, 3, 4, 5, 255
AFTER_ONE, AFTER_TWO = b"stmd", (b"re", b"ve", b"ll")

# Symbols: kinds, with what has to be known about the characters that follow.
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_LAST_SPACE, S_LAST_WHITE, S_WHITE = range(8)
# States: a piece has just ended; inside letters, numbers, others; after a space that joins what follows; inside white
# space; one or two letters of a contraction to come.
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, PREFIXED, IN_WHITE, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this character."""
    if state in (ONE_MORE, TWO_MORE):
        return (DONE if state == ONE_MORE else ONE_MORE), False
    if symbol in (S_LETTER, S_NUMBER, S_OTHER):
        inside = (IN_LETTERS, IN_NUMBERS, IN_OTHERS)[symbol]
        return inside, state not in (inside, PREFIXED)
    if symbol in (S_QUOTE1, S_QUOTE2):
        if state in (IN_OTHERS, PREFIXED):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == S_QUOTE1 else TWO_MORE), True
    if symbol == S_LAST_SPACE:
        return PREFIXED, True
    if symbol == S_LAST_WHITE:
        return DONE, True
    return IN_WHITE, state != IN_WHITE


#: Symbols 8 to 15 are 0 to 7 at the start of a segment, where the state before does not count; 16 changes nothing.
SYMBOLS, IDLE = 17, 16


class Splitter:
    """The transducer as tables, and the monoid of its state maps."""

    def __init__(self) -> None:
        self.next = np.zeros((8, SYMBOLS), np.uint8)
        self.cut = np.zeros((8, SYMBOLS), bool)
        for state in range(8):
            self.next[state, IDLE] = state
            for symbol in range(8):
                self.next[state, symbol], self.cut[state, symbol] = _step(state, symbol)
                self.next[state, symbol + 8] = _step(DONE, symbol)[0]
                self.cut[state, symbol + 8] = True
        maps = list(dict.fromkeys(tuple(self.next[:, s].tolist()) for s in range(SYMBOLS)))
        known = {m: i for i, m in enumerate(maps)}
        generators = len(maps)
        at = 0
        while at < len(maps):
            for g in range(generators):
                both = tuple(maps[g][x] for x in maps[at])
                if both not in known:
                    known[both] = len(maps)
                    maps.append(both)
            at += 1
        self.maps = np.array(maps, np.uint8)
        self.of_symbol = np.array([known[tuple(self.next[:, s].tolist())] for s in range(SYMBOLS)], np.uint16)
        self.compose = np.array([[known[tuple(b[x] for x in a)] for b in maps] for a in maps], np.uint16)

    def scan(self, maps: np.ndarray) -> np.ndarray:
        """All prefix compositions, in a logarithmic number of steps."""
        out, step = maps.copy(), 1
        while step < len(out):
            out[step:] = self.compose[out[:-step], out[step:]]
            step *= 2
        return out

    def cuts(self, symbols: np.ndarray) -> np.ndarray:
        """True for the characters that start a piece."""
        rows = -(-len(symbols) // CHUNK)
        padded = np.full(rows * CHUNK, IDLE, np.uint8)
        padded[: len(symbols)] = symbols
        columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
        whole = self.of_symbol[columns[0]]
        for column in columns[1:]:
            whole = self.compose[whole, self.of_symbol[column]]
        before = self.scan(whole)
        state = np.concatenate([[DONE], self.maps[before[:-1], DONE]]) if rows else np.zeros(0, np.uint8)
        out = np.empty(columns.shape, bool)
        for k, column in enumerate(columns):
            out[k] = self.cut[state, column]
            state = self.next[state, column]
        return np.ascontiguousarray(out.T).reshape(-1)[: len(symbols)]


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 as itself, the rest from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Merges:
    """Tokens of a vocabulary, by number, as a trie of bytes, and which tokens stay apart."""

    def __init__(self, model: dict) -> None:
        codes = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        number = {t: i for i, t in enumerate(dict.fromkeys([*codes, *(a + b for a, b in pairs)]))}
        if len(number) != len(codes) + len(pairs):
            raise ValueError("two merges give the same token")
        self.rank = {number[a] << 32 | number[b]: r for r, (a, b) in enumerate(pairs)}
        parts: list[tuple[int, int] | None] = [None] * len(codes) + [(number[a], number[b]) for a, b in pairs]
        # The tokens at either edge while a token is built, each with the rank of the merge that takes it away.
        never = len(pairs)
        self.edges: tuple[list, list] = ([], [])
        for token, both in enumerate(parts):
            for side, edges in enumerate(self.edges):
                rest = ()
                if both:
                    (inner, _), *further = edges[both[side]]
                    rest = ((inner, self.rank[both[0] << 32 | both[1]]), *further)
                edges.append(((token, never), *rest))
        self.fitting: dict[int, bool] = {}
        good = [True] * len(codes)
        for token, (a, b) in enumerate(parts[len(codes) :], len(codes)):
            good.append(good[a] and good[b] and not self._crossed(a, b, self.rank[a << 32 | b]))
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner = [True]
        for text, token in number.items():
            node = 0
            for byte in b"".join(codes[c] for c in text) if good[token] else b"":
                self.inner[node] = True
                node = self.child.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
            if node:
                self.token[node] = token

    def _crossed(self, left: int, right: int, own: int = -1) -> bool:
        """Whether a merge over the border comes first; of merges of one rank, those further left come first."""
        rank = self.rank.get
        for a, a_until in self.edges[1][left]:
            for b, b_until in self.edges[0][right]:
                r = rank(a << 32 | b, -1)
                if -1 < r < a_until and r <= b_until and r != own:
                    return True
        return False

    def apart(self, left: int, right: int) -> bool:
        known = self.fitting.get(left << 32 | right)
        if known is None:
            if len(self.fitting) >= PAIRS_HELD:
                self.fitting.clear()
            known = self.fitting[left << 32 | right] = not self._crossed(left, right)
        return known


class Counter:
    """The transducer over bytes. A transition is one 32-bit integer: next state, and change of the count plus 128.

    A state is a text of (node, last token, count) for every suffix that begins a token; -1 where no token is before it.
    """

    def __init__(self, merges: Merges, held: int = STATES_HELD) -> None:
        self.merges, self.held = merges, held
        self.start = (0, -1, 0)
        self._empty()

    def _empty(self) -> None:
        self.states, self.known = [self.start], {self.start: 0}
        self.column = np.zeros(256, np.int64)
        self.columns = 1  # column 0 is for bytes that were not met: never filled
        self.table = np.full((1024, 32), -1, np.int32)

    def _number(self, state: tuple) -> int:
        found = self.known.get(state)
        if found is None:
            found = self.known[state] = len(self.states)
            self.states.append(state)
            if found == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return found

    def _compile(self, state: int, byte: int) -> int:
        merges, before = self.merges, self.states[state]
        child, token, inner = merges.child.get, merges.token, merges.inner
        after: list[int] = []
        last, change = -1, 0
        for i in range(0, len(before), 3):
            node = child(before[i] << 8 | byte, 0)
            if node:
                if last < 0 <= token[node] and (before[i + 1] < 0 or merges.apart(before[i + 1], token[node])):
                    last, change = token[node], before[i + 2] + 1
                if inner[node]:
                    after += (node, before[i + 1], before[i + 2])
        if last < 0:
            raise ValueError("the vocabulary is not closed under its merges")
        for i in range(2, len(after), 3):
            after[i] -= change
        value = self._number((*after, 0, last, 0)) << 8 | change + 128
        if not self.column[byte]:
            self.column[byte] = self.columns
            self.columns += 1
        if self.columns > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.full((len(self.table), 32), -1, np.int32)], axis=1)
        self.table[state, self.column[byte]] = value
        return value

    def _follow(self, start: tuple, piece: bytes) -> int:
        state, total = self._number(start), 0
        for byte in piece:
            if len(self.states) >= self.held:
                state = int(self._renew(np.array([state]))[0])
            value = int(self.table[state, self.column[byte]])
            if value < 0:
                value = self._compile(state, byte)
            state, total = value >> 8, total + (value & 255) - 128
        return total

    def _renew(self, used: np.ndarray) -> np.ndarray:
        """Forget all states but those in use; their new numbers."""
        own, place = np.unique(used, return_inverse=True)
        own = [self.states[s] for s in own.tolist()]
        self._empty()
        return np.array([self._number(s) for s in own], np.int64)[place]

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        place, sizes = starts[order], sizes[order]
        total = np.zeros(len(order), np.int64)
        state = np.zeros(len(order), np.int64)
        left = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        for k, m in enumerate(left.tolist()):
            if m <= FEW:
                for i, start in enumerate([self.states[s] for s in state[:m].tolist()]):
                    total[i] += self._follow(start, data[place[i] + k : place[i] + sizes[i]].tobytes())
                break
            if len(self.states) >= self.held:
                state[:m] = self._renew(state[:m])
            byte = data[place[:m] + k]
            value = self.table[state[:m], self.column[byte]]
            new = np.flatnonzero(value < 0)
            if len(new):
                keys, which = np.unique(state[new] << 8 | byte[new], return_inverse=True)
                value[new] = np.array([self._compile(x >> 8, x & 255) for x in keys.tolist()])[which]
            state[:m] = value >> 8
            total[:m] += (value & 255) - 128
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


class Tokens:
    """Counts tokens of slices of texts, for one vocabulary."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        text = json.loads(vocabulary)
        model, cutting, added = text["model"], text.get("pre_tokenizer") or {}, text.get("added_tokens") or []
        plain = cutting.get("type") == "ByteLevel" and cutting.get("use_regex", True) and not cutting.get("add_prefix_space")
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        flags = [a for a in added if a.get("single_word") or a.get("lstrip") or a.get("rstrip")]
        if text.get("normalizer") or model.get("type") != "BPE" or not plain or odd or flags:
            raise ValueError("only byte-level BPE without normaliser and fallback is compiled")
        self.pre_tokenizer = Tokenizer.from_str(vocabulary).pre_tokenizer
        names = sorted((a["content"].encode() for a in added), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.splitter = Splitter()
        self.counter = Counter(Merges(model))
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.kinds[ord("'")] = QUOTE
        self.kinds[ord(" ")] = SPACE

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """Kinds of characters; those met for the first time are put to the library beside one of each kind."""
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            for p in np.unique(points[kinds == UNKNOWN]).tolist():
                beside = [len(self.pre_tokenizer.pre_tokenize_str(c + chr(p))) == 1 for c in "a1!"]
                self.kinds[p] = beside.index(True) if any(beside) else WHITE
            kinds = self.kinds[points]
        return kinds

    def _segments(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where segments start, and where special tokens do."""
        at, named = [part.offsets[:-1]], []
        data = part.data.tobytes()
        if self.special and self.special.search(data):
            for begin, end in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist()):
                for found in self.special.finditer(data, begin, end):
                    named.append(found.span())
        spans = np.array(named, np.int64).reshape(-1, 2)
        at += [spans[:, 0], spans[:, 1]]
        starts = np.unique(np.concatenate(at))
        return starts[starts < len(part.data)], spans

    def count(self, part: Slice) -> np.ndarray:
        """Tokens of each row of a slice."""
        data = part.data
        if not len(data):
            return np.zeros(part.rows, np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = code_points(data, lead)
        kinds = self._kinds(points)
        segments, spans = self._segments(part)
        first = np.zeros(len(lead) + 2, bool)
        first[np.searchsorted(lead, segments)] = True
        first[len(lead) :] = True
        after = np.concatenate([points[1:], [0, 0]])
        white = (kinds == WHITE) | (kinds == SPACE)
        last = ~(first[1:-1] | np.concatenate([white[1:], [False]]))
        symbols = kinds.copy()
        symbols[kinds == SPACE] = S_LAST_SPACE
        symbols[kinds == WHITE] = S_LAST_WHITE
        symbols[white & ~last] = S_WHITE
        quote = kinds == QUOTE
        symbols[quote] = S_OTHER
        at = np.flatnonzero(quote & ~first[1:-1])
        one = np.isin(after[at], list(AFTER_ONE))
        symbols[at[one]] = S_QUOTE1
        two = np.zeros(len(at), bool)
        for x, y in AFTER_TWO:
            two |= (after[at] == x) & (after[at + 1] == y) & ~first[at + 2]
        symbols[at[two]] = S_QUOTE2
        symbols[first[:-2]] += 8
        starts = lead[self.splitter.cuts(symbols)]
        ends = np.append(starts[1:], len(data))
        counted = np.ones(len(starts), bool)
        if len(spans):
            within = np.searchsorted(spans[:, 0], starts, "right") - 1
            counted = (within < 0) | (starts >= spans[within, 1])
        tokens = np.zeros(len(starts) + 1, np.int64)
        tokens[:-1][counted] = self.counter.count(data, starts[counted], ends[counted])
        if len(spans):
            tokens[np.searchsorted(starts, spans[:, 0])] = 1
        sums = np.concatenate([[0], np.cumsum(tokens)])
        bounds = np.searchsorted(starts, part.offsets)
        return sums[bounds[1:]] - sums[bounds[:-1]]


def code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Characters that start at the given bytes of UTF-8."""
    first = data[lead].astype(np.int32)
    if len(lead) == len(data):
        return first
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    points = first.copy()
    for size, mask, floor in ((2, 0x1F, 0xC0), (3, 0x0F, 0xE0), (4, 0x07, 0xF0)):
        rows = np.flatnonzero(first >= floor)
        value = first[rows] & mask
        for k in range(1, size):
            value = value << 6 | (padded[lead[rows] + k] & 0x3F)
        points[rows] = value
    return points


_compiled: dict[int, Tokens] = {}


def compiled(vocabulary: str) -> Tokens:
    """The worker's transducers for a vocabulary; what they have compiled lasts until it turns to another operator."""
    key = hash(vocabulary)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Tokens(vocabulary)
    hold(__name__, _compiled.clear)
    return _compiled[key]


def _count(batches, vocabulary: str) -> Iterator[pa.RecordBatch]:
    worker = compiled(vocabulary)
    for batch in batches:
        for part in slices(batch.column("text")):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(part.first, part.rows),
                    pa.array(np.diff(part.offsets).astype(np.int64)),
                    pa.array(worker.count(part)),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )


def vocabulary_text(path: str | None = None) -> str:
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return f.read()


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens. The vocabulary file is read on the driver and goes to the tasks; its size is fixed."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return in_arrow(rows, _count, "doc_id long, n_bytes long, n_tokens long", vocabulary_text(path))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
