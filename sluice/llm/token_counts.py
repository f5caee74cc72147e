"""Token counts of whole texts from pre-token lengths, looked up in two tiers where they are read.

How many tokens a pre-token has does not depend on its surroundings, so a text's count is a
sum of lengths. The first tier is a compact hash table of the lengths of frequent
pre-tokens, of fixed size, which is broadcast; it answers most of a block of texts with a
few array lookups. What it lacks is encoded by the tokenizer's own library, once per
worker: the second tier is a bounded cache in each worker. No pre-token is ever shuffled.

White space always parts pre-tokens. Within ASCII words, letters, single digits and runs of
other characters are parted as well. A word with an apostrophe (contractions), with
characters beyond ASCII (normalisation can reach across them) or with the start of a special
token is not taken apart, but handed to the library whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SPACED, blocks, mix, text_bytes, texts

SAMPLE_ROWS = 10_000  # rows, about, of which the frequent pre-tokens are found
ENTRIES = 1 << 16  # frequent pre-tokens looked for
SLOTS = 1 << 18  # of the table; a slot holds one pre-token, 21 bytes each
WIDEST = 16  # bytes of a pre-token in the table
CACHED_BYTES = 64  # longer pre-tokens are encoded anew each time
CACHED_PIECES = 1 << 18  # then a worker's cache starts over: bounded memory

LETTER, DIGIT, OTHER, BEYOND = 1, 2, 3, 4


def _classes() -> np.ndarray:
    """The kind of every byte; 0 is white space."""
    kind = np.full(256, OTHER, np.uint8)
    kind[~SPACED] = 0
    kind[65:91] = kind[97:123] = LETTER
    kind[48:58] = DIGIT
    kind[128:] = BEYOND
    return kind


KIND = _classes()
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
# LOW_BYTES[n] keeps the first n bytes of a little-endian number of eight.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Pieces:
    """The pre-tokens of a block of texts, in order, as they are looked up.

    `start` and `end` are byte places in `data`, which is the block in lower case, except
    words that the library has to see as they are. `first` is the index of each text's
    first piece (and one more for the end).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data)
        kind = KIND[data]
        inside = kind > 0
        edge = np.zeros(n + 1, bool)  # a text starts here
        edge[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | edge[1:n]
        word = np.cumsum(opens) - 1
        special = np.zeros(n, bool)
        special[:-1] = (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        as_is = np.zeros(int(opens.sum()) + 1, bool)
        as_is[word[(kind == BEYOND) | special]] = True
        whole = as_is.copy()
        whole[word[data == ord("'")]] = True
        parts = inside.copy()
        parts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        starts = opens | parts & ~whole[word]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | starts[1:]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.data = np.where(as_is[word], data, FOLD[data]) if n else data

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first eight bytes, next eight bytes, size) of every piece; the size may be larger."""
        padded = np.zeros(len(self.data) + WIDEST, np.uint8)
        padded[: len(self.data)] = self.data
        eights = np.ndarray((len(self.data) + 8,), "<u8", padded, strides=(1,))
        size = self.end - self.start
        low = eights[self.start] & LOW_BYTES[np.minimum(size, 8)]
        high = eights[self.start + 8 * (size > 8)] & LOW_BYTES[np.clip(size - 8, 0, 8)]
        return low, high, size


def _slots(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (mix(low ^ mix(high + size.astype(np.uint64))) & np.uint64(SLOTS - 1)).astype(np.int64)


class Lengths:
    """Numbers of tokens of frequent pre-tokens. Whole keys are compared: no false answer."""

    def __init__(self, pieces: list[bytes], counts: list[int]) -> None:
        """`pieces` come most frequent first; of those that share a slot the first stays."""
        self.low, self.high = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.size, self.tokens = np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, np.int32)
        fitting = [(p, c) for p, c in zip(pieces, counts) if 0 < len(p) <= WIDEST]
        joined = np.frombuffer(b"".join(p.ljust(WIDEST, b"\0") for p, _ in fitting), "<u8").reshape(-1, 2)
        size = np.array([len(p) for p, _ in fitting], np.int64)
        low, high = joined[:, 0].copy(), joined[:, 1].copy()
        slot, chosen = np.unique(_slots(low, high, size), return_index=True)
        self.low[slot], self.high[slot], self.size[slot] = low[chosen], high[chosen], size[chosen]
        self.tokens[slot] = np.array([c for _, c in fitting], np.int32)[chosen]

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of tokens, whether they are known)."""
        slot = _slots(low, high, size)
        known = (self.low[slot] == low) & (self.high[slot] == high) & (self.size[slot] == size)
        return np.where(known, self.tokens[slot], 0).astype(np.int64), known


def library(spec: str):
    """The tokenizer of a file's contents, without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark spreads the work
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encoded_lengths(tokenizer, pieces: list[bytes]) -> list[int]:
    found = tokenizer.encode_batch([p.decode() for p in pieces], add_special_tokens=False)
    return [len(e) for e in found]


class Counter:
    """Token counts of blocks of texts: the table first, then the worker's cache."""

    def __init__(self, spec: str, table: Lengths) -> None:
        self.table = table
        self._tokenizer = library(spec)
        self._known: dict[bytes, int] = {}
        self.missed = 0

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of every text."""
        pieces = Pieces(data, offsets)
        counts, known = self.table.find(*pieces.keys())
        missing = np.flatnonzero(~known)
        if missing.size:
            counts[missing] = self._encode(pieces, missing)
        total = np.concatenate([[0], np.cumsum(counts)])
        return total[pieces.first[1:]] - total[pieces.first[:-1]]

    def _encode(self, pieces: Pieces, missing: np.ndarray) -> list[int]:
        self.missed += len(missing)
        raw = pieces.data.tobytes()
        keys = [raw[a:b] for a, b in zip(pieces.start[missing].tolist(), pieces.end[missing].tolist())]
        if len(self._known) > CACHED_PIECES:
            self._known.clear()
        fresh = list(set(keys).difference(self._known))
        self._known.update(zip(fresh, encoded_lengths(self._tokenizer, fresh)))
        found = [self._known[k] for k in keys]
        for piece in fresh:
            if len(piece) > CACHED_BYTES:
                del self._known[piece]
        return found


def check_tokenizer(spec: str) -> None:
    """Raise unless the file parts texts in the way `Pieces` relies on."""
    told = json.loads(spec)
    steps = told["pre_tokenizer"].get("pretokenizers", [told["pre_tokenizer"]])
    lower = [s["type"] for s in (told.get("normalizer") or {}).get("normalizers", [])]
    first = steps[0]
    if not (
        told["model"]["type"] == "BPE"
        and "Lowercase" in lower
        and first["type"] == "Split"
        and first["behavior"] == "Removed"
        and first["invert"]
        and first["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and all(t["content"].startswith("<|") and not t["normalized"] for t in told["added_tokens"])
        and told.get("post_processor") is None
    ):
        raise ValueError("only lower-case word BPE files that drop white space can be counted from pre-tokens")


def frequent_lengths(docs: DataFrame, spec: str, sample_rows: int = SAMPLE_ROWS, entries: int = ENTRIES) -> Lengths:
    """The table of the most frequent pre-tokens in about `sample_rows` rows.

    It only decides how fast texts are counted, never what is counted. Tasks count the
    sample's pre-tokens; the `entries` most frequent come to the driver, 16 bytes each.
    """
    n_rows = docs.count()  # a Parquet table knows it without reading the rows
    sample = texts(docs).select("text")
    if n_rows > sample_rows:
        sample = sample.sample(sample_rows / n_rows, seed=11)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in blocks(offsets):
                pieces = Pieces(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                low, high, size = pieces.keys()
                keys = np.stack([low, high, size.astype(np.uint64)], 1)[size <= WIDEST]
                if len(keys):
                    keys, n = np.unique(keys, axis=0, return_counts=True)
                    raw = np.ascontiguousarray(keys[:, :2]).tobytes()
                    own = [raw[WIDEST * k : WIDEST * k + s] for k, s in enumerate(keys[:, 2].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.binary()), pa.array(n, pa.int64())], names=["piece", "n"]
                    )

    counted = sample.mapInArrow(run, "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "piece").limit(entries).collect()
    pieces = [bytes(row.piece) for row in rows]
    return Lengths(pieces, encoded_lengths(library(spec), pieces))


RESULT = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 2048, sample_rows: int = SAMPLE_ROWS, entries: int = ENTRIES
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `tokenizer` is the path of a word BPE file on the driver; its contents (of fixed size)
    and the table of frequent pre-tokens (5.5 MB) are broadcast. The counts are those of the
    tokenizers library for the whole text, without added special tokens; special tokens
    that stand in a text count one. A null or empty text has no bytes and no tokens.
    Rows are independent: null doc_ids, repeated rows and ties keep a row each, other
    columns are ignored, an empty table gives no rows, and the documents are not shuffled.
    Texts of any length are read in blocks; an unbroken word is encoded in one piece.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    check_tokenizer(spec)
    table = frequent_lengths(docs, spec, sample_rows, entries)
    sent = docs.sparkSession.sparkContext.broadcast((spec, table.low, table.high, table.size, table.tokens))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hasattr(sent, "counter"):  # a worker that is used again keeps it and its cache
            spec, *arrays = sent.value
            own = Lengths([], [])
            own.low, own.high, own.size, own.tokens = arrays
            sent.counter = Counter(spec, own)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            n_tokens = np.zeros(len(offsets) - 1, np.int64)
            for i, j in blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                n_tokens[i:j] = sent.counter.count(part, offsets[i : j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(run, RESULT)
