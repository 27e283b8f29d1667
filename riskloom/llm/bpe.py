"""BPE encoding and decoding with content-defined chunks.

A rolling hash over the last ``WINDOW`` bytes cuts every text where the hash meets a mask, so equal passages of different
documents fall into equal chunks wherever they stand. A worker encodes each distinct chunk once and reuses it. The word
that a cut runs through is left out of both chunks; the joint is repaired by joining the pieces, over as many chunks as
it takes to reach white space on both sides, and encoding the whole word again. White space is where the tokenizer itself
can carry nothing over, so the repaired sequence is exactly the one that the library gives for the whole text.

This holds for vocabularies that drop white space before merging (``word_bpe_49k.json``). Stores are bounded: two
generations of words and chunks are held, the older one is let go when the younger is full. Chunks are reused within a
worker; sending all chunk texts and ids between workers costs more than encoding them again.

Defined cases: a NULL text is empty and has no ids and an empty decoding; strings of special tokens inside a text become
their ids, as in the library; repeated rows are each encoded; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import hold, in_arrow, table
from riskloom.llm.vectors import BLOCK, Slice, mix, power_tables, slices

WINDOW, CUT_BITS = 16, 9
WORDS_HELD, CHUNKS_HELD = 400_000, 20_000
VOCABULARY = "word_bpe_49k.json"

# Python splits at these four, the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPACE = re.compile("[^\\S\x1c\x1d\x1e\x1f]+")


class Generations:
    """A mapping of bounded size; what was used since the last change of generation is kept."""

    def __init__(self, size: int) -> None:
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and self.old:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def cuts(part: Slice) -> np.ndarray:
    """Byte positions in a slice after which a chunk ends; row bounds are not among them.

    A window never reaches over the start of a row, and no character is cut in two.
    """
    data, found = part.data, []
    step = BLOCK - WINDOW
    for begin in range(0, max(len(data) - WINDOW, 0), step):
        block = data[begin : begin + step + WINDOW].astype(np.uint64) + np.uint64(1)
        up, down = power_tables(len(block) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(block * up[: len(block)], dtype=np.uint64)])
            rolling = mix((sums[WINDOW:-1] - sums[: -WINDOW - 1]) * down[: len(block) - WINDOW])
        found.append(np.flatnonzero(rolling >> np.uint64(64 - CUT_BITS) == 0) + begin + WINDOW)
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    row = np.searchsorted(part.offsets, at, "right") - 1
    return at[(at - part.offsets[row] >= WINDOW) & (data[at] & 0xC0 != 0x80)]


def split_words(text: str) -> list[str]:
    if any(c in text for c in _SEPARATORS):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


def word_parts(word: str) -> tuple[str, ...]:
    """Parts that the tokenizer encodes alike: Latin letters and a point or comma behind them; case does not count."""
    end = word[-1] if word[-1] in ".," and len(word) > 1 else ""
    body = word[:-1] if end else word
    # Some letters are no letters alone when lower-cased, such as dotted I; the tokenizer joins what they leave with a point.
    if not body.isalpha() or max(body) >= "\u0250" or not body.lower().isalpha():
        return (word,)
    if body.isascii():
        body = body.lower()
    return (body, end) if end else (body,)


def is_space(char: str) -> bool:
    return char.isspace() and char not in _SEPARATORS


class Encoder:
    """A tokenizer with its stores of words and chunks."""

    def __init__(self, vocabulary: str, words_held: int | None = None) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = {i: name for name, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        held = words_held or WORDS_HELD
        self.words, self.chunks = Generations(held), Generations(max(1, CHUNKS_HELD * held // WORDS_HELD))

    def encode_words(self, words: list[str]) -> list[tuple[bytes, str]]:
        """(ids as 32-bit integers, decoding) of each word; those not held are encoded together."""
        found = [self.words.get(w) for w in words]
        missing = {w: word_parts(w) for w, f in zip(words, found) if f is None}
        if missing:
            fresh = {p: self.words.get(p) for parts in missing.values() for p in parts}
            unknown = [p for p, f in fresh.items() if f is None]
            for p, e in zip(unknown, self.tokenizer.encode_batch_fast(unknown, add_special_tokens=False)):
                fresh[p] = (np.array(e.ids, "<i4").tobytes(), " ".join([self.names[i] for i in e.ids]))
                self.words.put(p, fresh[p])
            for w, parts in missing.items():
                if parts != (w,):
                    ids, names = zip(*(fresh[p] for p in parts))
                    fresh[w] = (b"".join(ids), " ".join(names))
                    self.words.put(w, fresh[w])
            found = [fresh[w] if f is None else f for w, f in zip(words, found)]
        return found

    def encode_chunk(self, chunk: bytes) -> tuple[str, bytes, str, str, bool]:
        """(head, ids, decoding, tail, has white space): head and tail are pieces of words that a cut may run through."""
        held = self.chunks.get(chunk)
        if held is not None:
            return held
        text = chunk.decode()
        words = split_words(text)
        if not words:
            result = ("", b"", "", "", True)
        elif len(words) == 1 and not is_space(text[0]) and not is_space(text[-1]):
            result = (text, b"", "", "", False)
        else:
            head = "" if is_space(text[0]) else words.pop(0)
            tail = "" if is_space(text[-1]) else words.pop()
            inner = self.encode_words(words)
            result = (head, b"".join([i for i, _ in inner]), " ".join([d for _, d in inner if d]), tail, True)
        self.chunks.put(chunk, result)
        return result

    def encode(self, data: bytes, ends: list[int]) -> tuple[bytes, str]:
        """ids and decoding of a text, given the positions where its chunks end."""
        ids: list[bytes] = []
        decoded: list[str] = []
        pieces: list[str] = []
        start = 0

        def repair() -> None:
            word = "".join(pieces)
            pieces.clear()
            if word:
                found = self.encode_words([word])[0]
                ids.append(found[0])
                decoded.append(found[1])

        for end in ends:
            head, own, text, tail, spaced = self.encode_chunk(data[start:end])
            start = end
            if head:
                pieces.append(head)
            if spaced:
                repair()
                ids.append(own)
                decoded.append(text)
                if tail:
                    pieces.append(tail)
        repair()
        return b"".join(ids), " ".join([d for d in decoded if d])


_encoders: dict[tuple[int, int | None], Encoder] = {}


def encoder(vocabulary: str, words_held: int | None = None) -> Encoder:
    """The worker's encoder of a vocabulary; its stores last until the worker turns to another operator."""
    key = hash(vocabulary), words_held
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary, words_held)
    hold(__name__, _encoders.clear)
    return _encoders[key]


def _encode(batches, vocabulary: str, words_held: int | None = None) -> Iterator[pa.RecordBatch]:
    worker = encoder(vocabulary, words_held)
    for batch in batches:
        for part in slices(batch.column("text")):
            at = cuts(part)
            first = np.searchsorted(at, part.offsets)
            ids, decoded = [], []
            for r in range(part.rows):
                begin, end = int(part.offsets[r]), int(part.offsets[r + 1])
                ends = (at[first[r] : first[r + 1]] - begin).tolist()
                i, d = worker.encode(part.data[begin:end].tobytes(), [e for e in ends if e < end - begin] + [end - begin])
                ids.append(i)
                decoded.append(d)
            offsets = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(part.first, part.rows),
                    pa.ListArray.from_arrays(pa.array(offsets), values),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "ids", "decoded"],
            )


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, words_held: int | None = None) -> DataFrame:
    """doc_id, ids, decoded. The vocabulary file is read on the driver and goes to the tasks; its size is fixed.

    ``words_held`` bounds a generation of the store of words, about half a KB each, and that of chunks in proportion; smaller
    stores cost time, not results.
    """
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        vocabulary = f.read()
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return in_arrow(rows, _encode, "doc_id long, ids array<int>, decoded string", vocabulary, words_held)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded documents."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(table(spark, sf_dir, "documents")))
