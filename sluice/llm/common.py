"""Reading tables and walking Arrow batches of texts with NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts are handled in blocks of about this many bytes, to stay within a core's cache
# and a bounded memory. A longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, *more); other columns are left unread, a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all UTF-8 bytes, offsets): text i is `data[offsets[i]:offsets[i + 1]]`."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, raw = column.buffers()
    offsets = np.frombuffer(places, np.int64, n + 1, column.offset * 8)
    data = np.zeros(0, np.uint8) if raw is None else np.frombuffer(raw, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together have about `size` bytes, in order."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the public-domain splitmix64 finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code for every byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, hence invertible modulo 2^64
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        n = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """P with hash(i, j) = (P[j] - P[i]) * down[i], for `powers`."""
    up, _ = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], dtype=np.uint64, out=sums[1:])
    return sums


# Slots of the filter below: at most SLOTS / 64 rows (4 MB) are broadcast.
SLOTS = 1 << 24


def maybe_among(rows: DataFrame, column: str, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose `column` may be among the values of `key` in `wanted`.

    A bitmap of fixed size keeps most other rows out of the shuffle of the join that must
    follow; rows that only share a slot are left to that join.
    """

    def slot(name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name)), F.lit(SLOTS)).cast("int")

    bits = (
        wanted.select(slot(key).alias("_slot"))
        .groupBy(F.expr("_slot DIV 64").alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, _slot % 64))").alias("_bits"))
    )
    found = rows.withColumn("_slot", slot(column)).join(
        F.broadcast(bits), F.expr("_slot DIV 64") == F.col("_word")
    )
    return found.where(F.expr("shiftrightunsigned(_bits, _slot % 64) & 1 = 1")).select(*rows.columns)


class Words:
    """The words of a block of texts, in order.

    `start`, `end` are byte places in the block, `hash` a 64-bit hash of the word,
    `first` the index of each text's first word (and one more for the end).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, codes: np.ndarray) -> None:
        """`inside` says of every byte value whether it belongs to words."""
        mask = inside[data]
        before = np.zeros(len(data), bool)
        before[1:] = mask[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        self.start = np.flatnonzero(mask & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = mask[1:]
        after[edges[edges > 0] - 1] = False
        self.end = np.flatnonzero(mask & ~after) + 1
        sums = prefix_hashes(codes[data])
        _, down = powers(len(data) + 1)
        raw = (sums[self.end] - sums[self.start]) * down[self.start]
        self.hash = mix(raw + (self.end - self.start).astype(np.uint64))
        self.first = np.searchsorted(self.start, offsets)


def folded(codes: np.ndarray) -> np.ndarray:
    """Codes under which A-Z equal a-z."""
    same = codes.copy()
    same[65:91] = codes[97:123]
    return same


# Words between ASCII white space (space, tab to carriage return).
SPACED = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])


def shingles(words: Words, size: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): shingles of `size` consecutive words, and each text's first one.

    With `whole_if_short` a text of fewer words (but some) has one shingle, all of them.
    """
    counts = np.diff(words.first)
    n = np.maximum(counts - size + 1, 0)
    total = np.zeros(max(len(words.hash) - size + 1, 0), np.uint64)
    for k in range(size):
        weight = np.uint64(pow(0x9FB21C651E98DF25, k + 1, 1 << 64))
        total += words.hash[k : k + len(total)] * weight
    keep = np.zeros(len(words.hash) + 1, np.int32)
    long = n > 0
    keep[words.first[:-1][long]] += 1
    np.subtract.at(keep, words.first[:-1][long] + n[long], 1)
    chosen = np.flatnonzero(np.cumsum(keep)[: len(total)] > 0)
    hashes = mix(total[chosen])
    first = np.concatenate([[0], np.cumsum(n)])
    if whole_if_short and (few := np.flatnonzero((n == 0) & (counts > 0))).size:
        parts, extra = [], np.zeros(len(counts), np.int64)
        for i in few:
            own = words.hash[words.first[i] : words.first[i + 1]]
            value = np.array([len(own)], np.uint64)
            for h in own:
                value = mix(value * np.uint64(0x9FB21C651E98DF25) + h)
            parts.append(value[0])
            extra[i] = 1
        hashes = np.insert(hashes, first[few], np.array(parts, np.uint64))
        first = np.concatenate([[0], np.cumsum(n + extra)])
    return hashes, first


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
