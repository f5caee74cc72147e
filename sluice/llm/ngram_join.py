"""Jaccard self-join of documents over word n-grams as a blocked sparse matrix product.

The matrix has a row for every distinct n-gram set and a column for every n-gram. Two
sets link if their overlap, an entry of the product of the matrix with its transpose,
reaches the threshold. The product is taken in two steps, both exact:

1. Columns in a global order from rare to common. Of a set of n, sets that can link share
   at least SHARED n-grams among the first n - ceil(t n) + SHARED of both. Overlaps are
   accumulated over these columns only, and pairs below that bound are discarded, as are
   pairs whose sizes alone rule a link out. A column too full to pair up its rows chains
   them by size instead. What is left falls apart into clusters. A column can be full of
   sets that have little else in common, so the step is taken again within every large
   cluster, on its own counts and columns, as long as that splits it.
2. Within a cluster the whole rows are multiplied, block by block of documents of like
   size; pairs below the bound of their sizes are dropped, and each block passes on a
   spanning forest of its links.

The order comes from a table of counters of fixed size, in which the n-grams of all
documents are counted; any order gives the same links, a good one keeps clusters small.
Where n-grams outnumber the counters by far, common ones hide among the rare and fill
columns. The counters of a large cluster hold only its own n-grams.
Equal sets are one row throughout, so a text with very many copies counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SPACED, Words, blocks, byte_codes, folded, maybe_among, mix, shingles, signed, text_bytes, texts
from sluice.llm.components import components
from sluice.operators.skew import mark_hot, split_lookup
from sluice.sources.staging import Staging

COUNTERS, CHUNK = 1 << 22, 1 << 14
SHARED = 3  # n-grams that linked sets share in their first columns, at least
FULL = 48  # rows of a column that are paired up
BLOCK = 256  # documents of a block
LARGE = 4 * BLOCK  # documents of a cluster that is looked at again
COLUMNS = 2048  # columns that are multiplied at a time

CODES = folded(byte_codes(5))


def distinct_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text of a block."""
    hashes, first = shingles(Words(data, offsets, SPACED, CODES), size, whole_if_short=True)
    for a, b in zip(first[:-1], first[1:]):
        yield np.unique(hashes[a:b])


def digests(own: np.ndarray) -> tuple[int, int]:
    """A 96-bit digest of a set, as two signed numbers."""
    one = np.add.reduce(mix(own + np.uint64(0x51ED270B)), dtype=np.uint64)
    two = np.add.reduce(mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64) & np.uint64(0x7FFFFFFF)
    return int(np.int64(np.uint64(one).view(np.int64))), int(two)


def required(percent: int, n: int) -> int:
    """Overlap that a set of n must have with any partner, at least."""
    return -(-percent * n // 100)


def _profiles(size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint32)
        names = ["doc_id", "n", "d1", "d2", "chunk", "counts"]
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            salts = np.asarray(batch.column("salt")).view(np.uint64)
            rows = []
            for a, b in blocks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                for salt, own in zip(salts[a:b], distinct_sets(part, at, size)):
                    rows.append((len(own), *digests(own)))
                    counters[((own ^ salt) & np.uint64(COUNTERS - 1)).astype(np.int64)] += 1
            n, one, two = zip(*rows) if rows else ((), (), ())
            none = pa.nulls(len(rows), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 none, pa.nulls(len(rows), pa.binary())],
                names=names,
            )
        for k in range(0, COUNTERS, CHUNK):
            own = np.minimum(counters[k : k + CHUNK], 65535).astype(np.uint16)  # beyond, all are common
            if own.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     pa.array([k // CHUNK], pa.int32()), pa.array([own.tobytes()], pa.binary())],
                    names=names,
                )

    return run


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The steps by which columns are ordered: whole binary logarithms of the summed counts."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            own = np.frombuffer(counts, np.uint16).astype(np.int64)
            sums[chunk] = sums[chunk] + own if chunk in sums else own
    steps = [np.log2(np.maximum(v, 1)).astype(np.uint8).tobytes() for v in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(steps, pa.binary())], names=["chunk", "steps"])


def _first_columns(size: int, percent: int, rarity) -> Callable:
    """Rows (gram, d1, d2, n) of the leading columns, once for each set and salt of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rarity.value
        done: set[tuple[int, int, int]] = set()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            salts = np.asarray(batch.column("salt")).view(np.uint64)
            for a, b in blocks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                grams, ids = [np.zeros(0, np.uint64)], []
                for salt, own in zip(salts[a:b], distinct_sets(part, at, size)):
                    n = len(own)
                    if n == 0 or (*(key := digests(own)), int(salt)) in done:
                        continue
                    done.add((*key, int(salt)))
                    length = min(n, n - required(percent, n) + SHARED)
                    own = own ^ salt
                    rank = order[(own & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64)
                    rank = (rank << np.uint64(57)) | (own >> np.uint64(7))
                    grams.append(own[np.argsort(rank, kind="stable")[:length]])
                    ids.append((*key, n, length))
                one, two, n, length = (np.array(c, np.int64) for c in (zip(*ids) if ids else ((), (), (), ())))
                yield pa.RecordBatch.from_arrays(
                    [signed(np.concatenate(grams)), *(pa.array(np.repeat(c, length)) for c in (one, two, n))],
                    names=["gram", "d1", "d2", "n"],
                )

    return run


def _pairs(percent: int) -> Callable:
    """Pairs of rows that share a column, from entries sorted by (gram, n, d1, d2)."""

    def all_pairs(gram: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = [], []
        for d in range(1, min(len(gram), FULL)):
            same = np.flatnonzero(gram[:-d] == gram[d:])
            if not same.size:
                break
            same = same[ids[same, 2] * 100 >= ids[same + d, 2] * percent]
            left.append(same)
            right.append(same + d)
        places = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in (left, right)]
        return ids[places[0]], ids[places[1]]

    def chains(gram: np.ndarray, ids: np.ndarray, head: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows tied to the first of those that follow each other by size; the last one's first."""
        follows = np.zeros(len(gram), bool)
        follows[1:] = (gram[1:] == gram[:-1]) & (ids[:-1, 2] * 100 >= ids[1:, 2] * percent)
        heads = ids[np.maximum.accumulate(np.where(follows, 0, np.arange(len(gram))))]
        if head is not None:  # the first row continues a chain
            heads[: np.argmin(np.append(follows[1:], False)) + 1] = head
        return heads[follows], ids[follows], heads[-1]

    def rows(a: np.ndarray, b: np.ndarray, full: bool) -> pa.RecordBatch:
        columns = [a[:, 0], a[:, 1], a[:, 2], b[:, 0], b[:, 1], b[:, 2], np.full(len(a), full)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in columns], names=["a1", "a2", "an", "b1", "b2", "bn", "full"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Entries of the column that is not finished: all of them, or, if it is full, the
        # last one and the head of its chain.
        gram, ids, head = np.zeros(0, np.int64), np.zeros((0, 3), np.int64), None
        for batch in chain(batches, [None]):
            if batch is not None:
                g = np.asarray(batch.column("gram"))
                i = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("d1", "d2", "n")], 1)
                gram, ids = np.concatenate([gram, g]), np.concatenate([ids, i])
            if not len(gram):
                continue
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1]).any(1)
            gram, ids = gram[new], ids[new]
            starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            sizes = np.diff(np.append(starts, len(gram)))
            big = sizes > FULL
            big[0] |= head is not None
            last = len(gram) if batch is None or big[-1] else starts[-1]
            in_big = np.repeat(big, sizes)[:last]
            few = np.flatnonzero(~in_big)
            if few.size and len((found := all_pairs(gram[few], ids[few]))[0]):
                yield rows(*found, False)
            many = np.flatnonzero(in_big)
            if many.size:
                a, b, head = chains(gram[many], ids[many], head)
                if len(a):
                    yield rows(a, b, True)
            if not big[-1]:
                head = None
            keep = len(gram) - 1 if big[-1] else last
            gram, ids = gram[keep:], ids[keep:]

    return run


def block_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets of one block."""
    m = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(m), n)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    column = np.cumsum(np.concatenate([[0], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
    owner = owner[shared]
    column = np.unique(column[shared], return_inverse=True)[1]
    overlap = np.zeros((m, m), np.float32)
    for low in range(0, int(column.max()) + 1 if column.size else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        incidence = np.zeros((m, COLUMNS), np.float32)
        incidence[owner[a:b], column[a:b] - low] = 1
        overlap += incidence @ incidence.T
    common = overlap.astype(np.int64)
    linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    linked &= (n > 0)[:, None] & (n > 0)[None, :]
    label = np.arange(m)
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], m).min(1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return [(int(ids[i]), int(ids[k])) for i, k in enumerate(label) if k != i]


def _products(size: int, percent: int) -> Callable:
    """Links of documents, from texts sorted by block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str]] = []
        block = None

        def finish() -> pa.RecordBatch:
            text = pa.array([t for _, t in held], pa.large_string())
            data, offsets = text_bytes(text)
            sets = []
            for a, b in blocks(offsets):
                sets += distinct_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
            found = block_links(np.array([i for i, _ in held], np.int64), sets, percent)
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for key, doc, text in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "text"))):
                if key != block and held:
                    yield finish()
                    held = []
                block = key
                held.append((doc, text))
        if held:
            yield finish()

    return run


def _blocks(clusters: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """(doc_id, block) of (doc_id, cluster, n): a small cluster is one block.

    In a large one documents of like size are dealt into blocks, and a block here is a
    pair of these whose sizes allow links. A clash of block numbers only costs time.
    """
    # Sizes that allow a link lie in the same step or in neighbouring ones.
    steps = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent) * 1.0001))).cast("int")
    known = staging.pin(clusters.withColumn("step", steps), "members")
    sizes = known.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    parts = known.groupBy(F.col("cluster").alias("_c"), F.col("step").alias("_s")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("_parts")
    )
    small = known.join(sizes.where(f"n_docs <= {BLOCK}").withColumnRenamed("cluster", "_k"), F.col("cluster") == F.col("_k"))
    whole = small.select("doc_id", F.xxhash64("cluster").alias("block"))
    large = known.join(sizes.where(f"n_docs > {BLOCK}").withColumnRenamed("cluster", "_k"), F.col("cluster") == F.col("_k"))
    near = parts.select("_c", F.explode(F.array(F.col("_s") - 1, F.col("_s"), F.col("_s") + 1)).alias("_at"), "_s", "_parts")
    # For every step the numbers of parts of itself and of its neighbours.
    around = near.groupBy("_c", "_at").agg(F.collect_list(F.struct("_s", "_parts")).alias("_around"))
    met = large.join(around, (F.col("cluster") == F.col("_c")) & (F.col("step") == F.col("_at")))
    own = F.filter("_around", lambda x: x["_s"] == F.col("step"))[0]["_parts"]
    met = met.withColumn("_part", F.pmod(F.xxhash64("doc_id"), own.cast("bigint")).cast("int"))
    other = met.select("doc_id", "cluster", "step", "_part", F.explode("_around").alias("_o")).select(
        "doc_id", "cluster", "step", "_part", F.col("_o._s").alias("_s"), F.explode(F.sequence(F.lit(0), F.col("_o._parts") - 1)).alias("_p")
    )
    here, there = F.struct(F.col("step").alias("s"), F.col("_part").alias("p")), F.struct(F.col("_s").alias("s"), F.col("_p").alias("p"))
    pair = other.select("doc_id", F.xxhash64("cluster", F.least(here, there), F.greatest(here, there)).alias("block"))
    return whole.unionAll(pair.distinct())


def _profile(salted: DataFrame, size: int) -> DataFrame:
    """From rows (doc_id, text, salt): a row for each text, and each task's counters in chunks."""
    return salted.mapInArrow(_profiles(size), "doc_id bigint, n int, d1 bigint, d2 bigint, chunk int, counts binary")


def _tied(salted: DataFrame, profile: DataFrame, sets: DataFrame, size: int, percent: int, staging: Staging) -> DataFrame:
    """(doc_id, cluster) of documents that may link with others: the first step.

    `salted` has rows (doc_id, text, salt), and columns are shared only under the same salt.
    """
    spark = salted.sparkSession
    sums = profile.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
    order = np.zeros(COUNTERS, np.uint8)
    for row in sums.mapInArrow(_add_up, "chunk int, steps binary").collect():  # one table of fixed size
        order[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.steps, np.uint8)
    rarity = spark.sparkContext.broadcast(order)

    entries = salted.select("text", "salt").mapInArrow(_first_columns(size, percent, rarity), "gram bigint, d1 bigint, d2 bigint, n bigint")
    sorted_ = entries.repartition("gram").sortWithinPartitions("gram", "n", "d1", "d2")
    pairs = staging.pin(
        sorted_.mapInArrow(_pairs(percent), "a1 bigint, a2 bigint, an bigint, b1 bigint, b2 bigint, bn bigint, full boolean"),
        "pairs",
    )
    needed = F.least(F.lit(SHARED), F.ceil((F.col("an") + F.col("bn")) * percent / F.lit(100.0 + percent)))
    near = pairs.groupBy("a1", "a2", "an", "b1", "b2", "bn").agg(
        F.count(F.lit(1)).alias("n_shared"), F.bool_or("full").alias("full")
    ).where(F.col("full") | (F.col("n_shared") >= needed))
    side = lambda x: sets.select(F.col("d1").alias(f"_{x}1"), F.col("d2").alias(f"_{x}2"), F.col("rep").alias(x)).hint("merge")
    candidates = (
        near.join(side("a"), (F.col("a1") == F.col("_a1")) & (F.col("a2") == F.col("_a2")))
        .join(side("b"), (F.col("b1") == F.col("_b1")) & (F.col("b2") == F.col("_b2")))
        .select("a", "b")
    )
    return components(candidates, staging).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))


def _clusters(known: DataFrame, profile: DataFrame, sets: DataFrame, size: int, percent: int, staging: Staging) -> DataFrame:
    """(doc_id, cluster) of documents that may link: no link leaves a cluster.

    Large clusters are looked at again, each by itself, until that leaves as many documents in
    large ones as before, or nearly. Documents that nothing is tied to any more are left out.
    """
    clusters = staging.pin(
        _tied(known.withColumn("salt", F.lit(0).cast("bigint")), profile, sets, size, percent, staging), "clusters"
    )
    before = None
    while True:
        large = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {LARGE}").select(F.col("cluster").alias("_large"))
        inside = staging.pin(
            clusters.join(large, F.col("cluster") == F.col("_large")).select(F.col("doc_id").alias("_id"), F.xxhash64("cluster").alias("salt")),
            "large",
        )
        n = inside.count()
        if not n or (before and n > 0.9 * before):
            return clusters
        before = n
        held = maybe_among(known, "doc_id", inside, "_id").join(inside.hint("merge"), F.col("doc_id") == F.col("_id"))
        held = staging.pin(held.select("doc_id", "text", "salt"), "large-texts", "zstd")
        own = staging.pin(_profile(held, size).where("chunk IS NOT NULL"), "large-profile")
        finer = _tied(held, own, sets, size, percent, staging)
        # A text of several documents can tie others than those inside.
        finer = finer.join(inside.select("_id").hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
        others = clusters.join(large, F.col("cluster") == F.col("_large"), "left_anti")
        clusters = staging.pin(others.unionByName(finer), "clusters")


def ngram_links(docs: DataFrame, size: int = 4, percent: int = 85, staging: Staging | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    Words are what stands between ASCII white space, A-Z lower-cased. A document's set has
    its distinct `size`-word shingles, or all its words as one if it has fewer; without
    words it is empty and links with nothing. Two documents link when
    100 * intersection >= percent * union; `component_id` is the smallest doc_id reachable
    by links. Rows that repeat a doc_id are one document, whose links count together. A
    null text is empty. Other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark)
    known = texts(docs)
    profile = staging.pin(_profile(known.withColumn("salt", F.lit(0).cast("bigint")), size), "profile")
    rows = profile.where("chunk IS NULL")
    sets = staging.pin(
        rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_rows")),
        "sets",
    )
    clusters = _clusters(known, profile, sets, size, percent, staging)
    by_rep = sets.groupBy(F.col("rep").alias("_rep")).agg(F.max("n").alias("n"))
    blocked = _blocks(clusters.join(by_rep, F.col("doc_id") == F.col("_rep")).select("doc_id", "cluster", "n"), percent, staging)
    per_doc = staging.pin(blocked.groupBy("doc_id").agg(F.collect_set("block").alias("blocks")), "blocks")
    needed_texts = maybe_among(known, "doc_id", per_doc, "doc_id").join(per_doc.withColumnRenamed("doc_id", "_id").hint("merge"), F.col("doc_id") == F.col("_id"))
    dealt = needed_texts.select(F.explode("blocks").alias("block"), "doc_id", "text").repartition("block").sortWithinPartitions("block")
    links = staging.pin(dealt.mapInArrow(_products(size, percent), "a bigint, b bigint"), "links")
    reach = components(links, staging)

    key = F.concat_ws(":", "d1", "d2")
    joined = sets.join(reach, F.col("rep") == F.col("node"), "left")
    least = F.coalesce("component", "rep").alias("component")
    table = mark_hot(joined.select(key.alias("_key"), least, "n_rows"), rows.count())
    found = split_lookup(
        rows.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, key).alias("_key")),
        "_key",
        table.where("hot"),
        table.where("NOT hot"),
        ["component"],
        spread_by=["doc_id"],
    )
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def first_of_groups(docs: DataFrame, size: int = 5, percent: int = 80, staging: Staging | None = None) -> DataFrame:
    """The rows of `docs` that stay, with all columns: of linked documents the smallest doc_id.

    Rows that repeat a doc_id are one document and stay or go together. Rows without
    doc_id have no place in an order of ids and stay. Null texts are empty and linked with
    nothing. An empty table gives no rows, and columns of any name may be there.
    """
    found = ngram_links(docs, size, percent, staging).where("component_id != doc_id")
    gone = found.select(F.col("doc_id").alias("gone")).distinct()
    # A row is carried as one value, so that its columns cannot clash with the other side's.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")
