"""Removal of repeated byte strings by induced suffix sorting over distributed shards.

A string of LENGTH bytes is repeated if it also starts elsewhere. Sorting all suffixes
would show it by the common prefix of neighbours, but a corpus has too many to move. As in
induced sorting, a sample is sorted and the order of the other suffixes is derived from it:

1. Sample. Each string has an anchor, the place of the smallest GRAM-byte hash in it. It
   depends on the string only, so equal strings have anchors with equal hashes. Runs of
   strings with one anchor become rows (hash of the anchor, hash of the run's bytes, place),
   shuffled and sorted by these: Spark's sort spills to disk, so shards may exceed memory.
   Runs of equal bytes are all repeated. A run whose anchor nothing else has is not.
2. Names. One run of each content asks for its bytes where others share the anchor's hash.
3. Induction. Within an anchor's shard the suffixes that start at anchors are sorted, with
   the common prefixes of neighbours. The suffixes one byte further left are then in order
   by (that byte, order of the suffix after it), and neighbours with the same byte share
   one byte more than the least common prefix between them before. So orders and common
   prefixes are carried left, byte by byte, up to the beginning of the longest run; a
   string is repeated exactly if it shares LENGTH bytes with a neighbour.

A text that has many copies sends at most two rows a task for each of its runs; further
copies are known to be repeated at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import blocks, byte_codes, maybe_among, mix, powers, prefix_hashes, text_bytes, texts
from sluice.sources.staging import Staging

LENGTH = 400
PLACE_BITS = 26
SHARD_BYTES = 32 << 20
CODES = byte_codes(10)

PLACED = "doc_id bigint, mark int, start int, n int, anchor int, key bigint, content bigint, done boolean, ask boolean"
NAMES = [c.split()[0] for c in PLACED.split(", ")]


def gram_of(length: int) -> int:
    return max(1, length // 4)


def runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, start, n, anchor, key, content) of the runs of strings with one anchor.

    `start` is the first string's place in its text, `n` the number of strings, `anchor`
    the anchor's place from `start`.
    """
    gram = gram_of(length)
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    sums = prefix_hashes(CODES[data])
    _, down = powers(len(data) + 1)
    hashes = mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    bits = np.uint64(max(PLACE_BITS, len(data).bit_length()))
    low = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)  # for every start
    inside = np.zeros(len(place) + 1, np.int32)
    sizes = np.diff(offsets)
    long = sizes >= length
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - length + 1] -= 1
    valid = np.cumsum(inside)[: len(place)] > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    first, end = np.flatnonzero(new), np.flatnonzero(last)
    if not first.size:
        return none
    text = np.searchsorted(offsets, first, "right") - 1
    content = mix((sums[end + length] - sums[first]) * down[first] + (end - first).astype(np.uint64))
    key = mix(hashes[place[first]] + np.uint64(0x632BE5AB))
    return (text, first - offsets[text], end - first + 1, place[first] - first, key.view(np.int64), content.view(np.int64))


def _rows(**columns) -> pa.RecordBatch:
    n = len(columns["doc_id"])
    kinds = {"doc_id": pa.int64(), "key": pa.int64(), "content": pa.int64(), "done": pa.bool_(), "ask": pa.bool_()}
    arrays = []
    for name in NAMES:
        kind, value = kinds.get(name, pa.int32()), columns.get(name)
        arrays.append(pa.nulls(n, kind) if value is None else value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def _sample(length: int) -> Callable:
    """The runs of every text. From the third like run of a task on they are done."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for a, b in blocks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                text, start, n, anchor, key, content = runs(part, at, length)
                if not len(text):
                    continue
                done = np.zeros(len(text), bool)
                for i, k in enumerate((key ^ (content << 1)).tolist()):
                    times = seen[k] = seen.get(k, 0) + 1
                    done[i] = times > 2
                own = pa.array(text + a)
                yield _rows(
                    doc_id=ids.take(own), mark=marks.take(own), start=start, n=n, anchor=anchor, key=key, content=content, done=done
                )

    return run


def _name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which runs are done, and which ask for their bytes; rows sorted by (key, content)."""
    held, several = None, False  # rows of the class that is not finished; more of its key before
    for batch in chain(batches, [None]):
        table = [t for t in (held, batch) if t is not None and t.num_rows]
        if not table:
            continue
        rows = pa.concat_batches(table) if len(table) > 1 else table[0]
        key, content = np.asarray(rows.column("key")), np.asarray(rows.column("content"))
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_class = new_key | np.concatenate([[True], content[1:] != content[:-1]])
        starts = np.flatnonzero(new_class)
        sizes = np.diff(np.append(starts, len(key)))
        key_of_class = (np.cumsum(new_key) - 1)[starts]
        classes = np.bincount(key_of_class)
        if several:
            classes[0] += 1
        cut = len(key)
        if batch is not None:
            # The last class waits; with it its key's only class, which then is the same.
            cut = int(starts[-1])
        repeated = np.repeat(sizes > 1, sizes) | np.asarray(rows.column("done"))
        asks = np.zeros(len(key), bool)
        asks[starts[classes[key_of_class] > 1]] = True
        out = (repeated | asks)[:cut]
        several = bool(classes[-1] > 1) if batch is not None else False
        chosen = np.flatnonzero(out)
        if chosen.size:
            yield _marked(rows, chosen, repeated, asks)
        held = None
        if batch is not None:
            rest = np.arange(cut, len(key))
            if len(rest) > 2:  # two tell that the class is repeated
                yield _marked(rows, rest[2:], np.ones(len(key), bool), np.zeros(len(key), bool))
                rest = rest[:2]
            held = rows.take(pa.array(rest))


def _marked(rows: pa.RecordBatch, chosen: np.ndarray, done: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
    part = rows.take(pa.array(chosen))
    columns = {name: part.column(name) for name in NAMES[:-2]}
    return _rows(**columns, done=done[chosen], ask=asks[chosen])


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y))


def _between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low:high]) for ranges that are not empty, by doubling."""
    out = np.empty(len(low), values.dtype)
    level = (np.frexp((high - low).astype(np.float64))[1] - 1).astype(np.int64)
    table, k = values, 0
    while True:
        own = level == k
        if own.any():
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k)])
        if k >= level.max(initial=0):
            return out
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
        k += 1


def induce(keys: np.ndarray, texts_: list[bytes], anchors: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) repeated string of every run, from its start; (-1, -1) without any.

    Run i has the bytes `texts_[i]`, its anchor `anchors[i]` bytes in; only runs of equal
    `keys` are compared.
    """
    first, last = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
    tails = [t[a:] for t, a in zip(texts_, anchors.tolist())]
    by = keys.tolist()
    order = np.array(sorted(range(len(by)), key=lambda i: (by[i], tails[i])), np.int64)
    # prefix[k]: bytes that the k-th suffix in order shares with the one before it.
    prefix = np.zeros(len(order), np.int64)
    for k in range(1, len(order)):
        i, j = order[k - 1], order[k]
        if by[i] == by[j]:
            prefix[k] = common_prefix(tails[i], tails[j])
    data = np.frombuffer(b"".join(texts_), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts_])])[:-1] + anchors
    shard = np.unique(keys, return_inverse=True)[1].astype(np.int64)
    for step in range(int(anchors.max()) + 1 if len(anchors) else 0):
        if step:
            # Suffixes one byte further left: those of runs that reach so far.
            places = np.flatnonzero(anchors[order] >= step)
            members = order[places]
            kind = shard[members] * 256 + data[at[members] - step]
            sort = np.argsort(kind, kind="stable")
            places, members, kind = places[sort], members[sort], kind[sort]
            longer = np.zeros(len(members), np.int64)
            same = np.flatnonzero(kind[1:] == kind[:-1]) + 1
            if same.size:
                longer[same] = 1 + _between(prefix, places[same - 1] + 1, places[same] + 1)
            order, prefix = members, longer
        if not len(order):
            break
        shares = prefix >= length
        shares[:-1] |= shares[1:].copy()
        found = order[shares]
        # The string that starts here: the first step met is the last of the run.
        string = anchors[found] - step
        good = (string >= 0) & (string < n[found])
        found, string = found[good], string[good]
        fresh = last[found] < 0
        last[found[fresh]] = string[fresh]
        first[found] = string
    return first, last


def _induction(length: int) -> Callable:
    """Repeated parts of the runs, from rows sorted by key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def finish(rows: list[dict]) -> pa.RecordBatch:
            first, last = induce(
                np.array([r["key"] for r in rows], np.int64),
                [r["bytes"] for r in rows],
                np.array([r["anchor"] for r in rows], np.int64),
                np.array([r["n"] for r in rows], np.int64),
                length,
            )
            found = [i for i in np.flatnonzero(first >= 0).tolist() if not rows[i]["done"]]
            return _rows(
                doc_id=[rows[i]["doc_id"] for i in found],
                mark=[rows[i]["mark"] for i in found],
                start=[rows[i]["start"] + int(first[i]) for i in found],
                n=[int(last[i] - first[i]) + 1 for i in found],
                done=[True] * len(found),
            )

        for batch in batches:
            for row in batch.to_pylist():
                if size > SHARD_BYTES and row["key"] != held[-1]["key"]:
                    yield finish(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield finish(held)

    return run


def _cut_out(length: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, mark, text, asked in zip(*(batch.column(c) for c in ("doc_id", "mark", "text", "asked"))):
                data = text.as_py().encode()
                for r in asked.as_py():
                    part = data[r["start"] : r["start"] + r["n"] + length - 1]
                    out.append({"doc_id": doc.as_py(), "mark": mark.as_py(), **r, "bytes": part})
            kinds = [("doc_id", pa.int64()), ("mark", pa.int32()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()),
                     ("anchor", pa.int32()), ("done", pa.bool_()), ("bytes", pa.binary())]
            yield from pa.Table.from_pylist(out, schema=pa.schema(kinds)).to_batches()

    return run


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that cover the same, as few as possible."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "spans"))):
            data = text.as_py().encode()
            gone = merged((s["start"], s["end"]) for s in spans.as_py() or ())
            kept, place = [], 0
            for start, end in gone:
                kept.append(data[place:start])
                place = end
            kept.append(data[place:])
            rows.append({
                "doc_id": doc.as_py(),
                "n_bytes": len(data),
                "spans": [{"start": s, "end": e} for s, e in gone],
                "kept": b"".join(kept),
            })
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())]
        yield from pa.Table.from_pylist(rows, schema=pa.schema(kinds)).to_batches()


def remove_repeats(docs: DataFrame, length: int = LENGTH, staging: Staging | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, spans (start, end of removed bytes), kept.

    Texts are UTF-8 bytes, a null text has none. A byte goes if a string of `length` bytes
    that covers it also starts anywhere else, in the same text or in another; strings never
    cross texts and are judged on the input. `spans` are the maximal removed runs; `kept`
    may end within a character. Texts shorter than `length` stay whole. Repeated rows are
    texts of their own, so each repeats the other. Other columns are ignored, an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    known = texts(docs).withColumn("mark", F.hash("text"))
    sampled = known.mapInArrow(_sample(length), PLACED)
    # Runs that are done need no company: they are dealt out by their place.
    apart = F.when(F.col("done"), F.xxhash64("doc_id", "start")).otherwise(F.col("key"))
    dealt = sampled.withColumn("key", apart).withColumn("content", F.when(F.col("done"), F.xxhash64("start", "doc_id")).otherwise(F.col("content")))
    sorted_ = dealt.repartition("key").sortWithinPartitions("key", "content")
    named = staging.pin(sorted_.mapInArrow(_name, PLACED), "runs")
    same_doc = lambda a, b: (F.col("doc_id").eqNullSafe(F.col(a))) & (F.col("mark") == F.col(b))
    asks = (
        named.where("ask")
        .groupBy(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"))
        .agg(F.collect_list(F.struct("key", "start", "n", "anchor", "done")).alias("asked"))
    )
    shards = (
        maybe_among(known, "doc_id", asks, "_doc")
        .join(asks.hint("merge"), same_doc("_doc", "_mark"))
        .select("doc_id", "mark", "text", "asked")
        .mapInArrow(
            _cut_out(length),
            "doc_id bigint, mark int, key bigint, start int, n int, anchor int, done boolean, bytes binary",
        )
    )
    induced = staging.pin(
        shards.repartition("key").sortWithinPartitions("key").mapInArrow(_induction(length), PLACED), "induced"
    )
    end = F.col("start") + F.col("n") + F.lit(length - 1)
    spans = (
        named.where("done").unionAll(induced)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"))
        .agg(F.collect_set(F.struct("start", end.cast("int").alias("end"))).alias("spans"))
    )
    return (
        known.join(spans.hint("merge"), same_doc("_doc", "_mark"), "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_remove, "doc_id bigint, n_bytes bigint, spans array<struct<start int, end int>>, kept binary")
    )
