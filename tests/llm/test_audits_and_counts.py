"""Token counts, centroid clustering, filter audit: each against brute force."""

import hashlib
import math
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from sluice.llm import centroids, filter_audit, token_counts
from sluice.llm.common import blocks, text_bytes
from tests.llm.helpers import SCHEMA, awkward, documents, empty, prose

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def spec():
    with open(WORDS, encoding="utf-8") as file:
        return file.read()


def tricky_texts():
    pick = random.Random(3)
    ascii_only = ["".join(chr(pick.randrange(128)) for _ in range(pick.randrange(60))) for _ in range(4000)]
    parts = [
        "ab ", " the and", "AJK̊́̌Å", "é一\U0001f600 a1.", "'s't're'LL'd", "<|", "|>",
        "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " \t\n\x0b\x85\xa0 　", "don't", "Größe", "İ", "J̌",
    ]
    mixed = ["".join(pick.choice(parts + list("".join(parts))) for _ in range(pick.randrange(60))) for _ in range(4000)]
    wide = ["".join(chr(pick.randrange(0x20, 0x3000)) for _ in range(40)) for _ in range(1000)]
    return ascii_only + mixed + wide + ["", " ", "\x00", "x" * 70_000, "a b " * 20_000]


@pytest.mark.parametrize("filled", [False, True])
def test_counts_equal_the_library(spec, filled):
    texts = tricky_texts()
    library = token_counts.library(spec)
    table = token_counts.Lengths([], [])
    if filled:
        frequent = [b"the", b"a", b"\x00", b"ab", b"1", b".", "größe".encode(), b"<|", b"abcdefghijklmnop"]
        table = token_counts.Lengths(frequent, token_counts.encoded_lengths(library, frequent))
    counter = token_counts.Counter(spec, table)
    data, offsets = text_bytes(pa.array(texts))
    got = [counter.count(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in blocks(offsets)]
    wanted = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    different = np.flatnonzero(np.concatenate(got) != wanted)
    assert not different.size, [texts[i] for i in different[:3]]


def test_table_answers_whole_keys_only(spec):
    table = token_counts.Lengths([b"abcdefgh", b"abcdefghi", b"a", b"abcdefghijklmnopq"], [3, 4, 1, 9])
    text = b"abcdefgh abcdefghi a b abcdefghijklmnop abcdefghijklmnopq abcdefg"
    pieces = token_counts.Pieces(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    counts, known = table.find(*pieces.keys())
    assert counts.tolist() == [3, 4, 1, 0, 0, 0, 0] and known.tolist() == [True] * 3 + [False] * 4


def test_worker_cache_is_bounded(spec, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_PIECES", 50)
    counter, library = token_counts.Counter(spec, token_counts.Lengths([], [])), token_counts.library(spec)
    for seed in range(20):
        texts = [prose(seed, 30, 10_000) + " " + "y" * 100]
        assert counter.count(*text_bytes(pa.array(texts))).tolist() == [len(library.encode(texts[0]))]
        assert len(counter._known) <= 50 + 31 and not any(len(k) > 64 for k in counter._known)


@pytest.mark.parametrize("sample_rows", [2, 10_000])
def test_counted_documents(spark, spec, sample_rows):
    docs, library = awkward(spark), token_counts.library(spec)
    rows = token_counts.count_tokens(docs, WORDS, sample_rows=sample_rows).collect()
    assert len(rows) == docs.count()
    wanted = Counter()
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False))
        wanted[r.doc_id, len((r.text or "").encode()), n, n > 2048] += 1
    assert Counter(map(tuple, rows)) == wanted
    assert token_counts.count_tokens(empty(spark), WORDS).collect() == []


def test_other_kinds_of_tokenizers_are_refused(spark):
    with pytest.raises(ValueError, match="word BPE"):
        token_counts.count_tokens(empty(spark), public_tokenizers.path("byte_bpe_50k.json"))


def test_documents_are_not_shuffled(spark):
    plan = token_counts.count_tokens(documents(spark, ["a b", "c"]), WORDS)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def brute_nearest(x, c):
    distances = ((x[:, None, :].astype(object) - c[None].astype(object)) ** 2).sum(2)
    best = [min((d, k) for k, d in enumerate(row)) for row in distances]
    return [k for _, k in best], [d for d, _ in best]


@pytest.mark.parametrize(("dims", "k", "spread"), [(64, 40, 60), (3, 7, 2), (1, 5, 4), (5, 1, 9), (4, 9, 0), (2, 6, 1 << 27)])
def test_threshold_walk_finds_the_nearest(dims, k, spread):
    random_ = np.random.default_rng(dims * 100 + k)
    c = random_.integers(-spread, spread + 1, (k, dims))
    x = np.concatenate([random_.integers(-spread, spread + 1, (300, dims)), c, c[:1] + 0 * c[:1]])
    who, distance = centroids.SortedCentroids(c).nearest(x)
    assert (who.tolist(), distance.tolist()) == brute_nearest(x, c)


def test_walk_stops_before_all_centroids_are_measured():
    """One centroid is close, the others far: they are never met before the walk stops."""
    c = np.arange(50)[:, None] * 1000 + np.zeros((50, 4), int)
    lists = centroids.SortedCentroids(c)
    lists.centroids = lists.centroids.copy()
    lists.centroids[10:] = 1  # were one of these measured, it would win
    who, distance = lists.nearest(np.full((1, 4), 3))
    assert (who[0], distance[0]) == (0, 36)


def brute_clusters(rows, dims, k, rounds):
    kept = [
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    c = np.array([x for _, x in seeds[:k]], object)
    x = np.array([v for _, v in kept], object)
    for _ in range(rounds):
        own, _ = brute_nearest(x, c)
        for j in range(len(c)):
            mine = [v for v, o in zip(x, own) if o == j]
            if mine:
                c[j] = [s // len(mine) for s in sum(mine)]
    own, distance = brute_nearest(x, c)
    inertia = Counter()
    for o, d in zip(own, distance):
        inertia[o] += d
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return Counter((i, o, d, inertia[o], sum(distance), digest[o]) for (i, _), o, d in zip(kept, own, distance))


def test_clusters_equal_brute_force(spark):
    random_ = np.random.default_rng(8)
    rows = [(i, [float(x) for x in random_.normal(0, 0.2, 6)]) for i in range(200)]
    rows += [(7, [0.5] * 6), (7, [0.5] * 6), (None, [0.1] * 6), (300, None), (301, [0.1] * 5), (302, [])]
    rows += [(303, [None] + [0.0] * 5), (304, [math.nan] * 6), (305, [math.inf] + [0.0] * 5)]
    rows += [(400 + i, [-0.25] * 6) for i in range(150)]  # a third of all rows are one vector
    df = spark.createDataFrame(rows, "vec_id bigint, v array<double>").selectExpr("*", "0 AS cluster", "0 AS x", "1 AS n")
    got = centroids.cluster_vectors(df.repartition(3), "v", dims=6, k=9)
    assert Counter(map(tuple, got.collect())) == brute_clusters(rows, 6, 9, 5)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-3.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert Counter(map(tuple, centroids.cluster_vectors(df, dims=2).collect())) == brute_clusters(rows, 2, 40, 5)
    none = centroids.cluster_vectors(df.where("vec_id > 9"), dims=2)
    assert none.collect() == [] and none.columns[0] == "vec_id"


def test_components_without_an_exact_distance_raise(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="no exact distance"):
        centroids.cluster_vectors(df, dims=2).collect()


def brute_audit(docs, labels):
    """Every order applied to every document, step by step."""
    judged = []
    for d in docs:
        text = d.text or ""
        words = [w for w in text.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if d.doc_id is not None and any(
            o.doc_id is not None and o.doc_id < d.doc_id and (o.text or "") == text for o in docs
        ):
            fails.add("E")
        good = any(i == d.doc_id and q == 1 for i, q, _ in labels if i is not None)
        toxic = any(i == d.doc_id and t == 1 for i, _, t in labels if i is not None)
        judged.append((d.lang or "", fails, good, toxic))
    out, shapley = {}, Counter()
    for part in {j[0] for j in judged}:
        for order in map("".join, permutations("ABCDE")):
            left = [j for j in judged if j[0] == part]
            everyone = list(left)
            for step, f in enumerate(order, 1):
                removed = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                failing = sum(f in j[1] for j in everyone)
                out[part, order, step] = (
                    len(left), len(removed), failing - len(removed), sum(j[1] == {f} for j in everyone),
                    sum(j[2] for j in removed), sum(j[3] for j in removed),
                )
                shapley[part, f] += len(removed)
    return {key: (*value, shapley[key[0], key[1][key[2] - 1]]) for key, value in out.items()}


def audited(docs, labels):
    rows = filter_audit.audit_filters(docs, labels).collect()
    found = {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        )
        for r in rows
    }
    assert len(found) == len(rows)
    return found


LABELS = [(0, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, None), (5, None, 1), (None, 1, 1), (999, 1, 1), (7, 1, None)]


@pytest.mark.parametrize("hot_share", [1000, 4])
def test_audit_equals_brute_force(spark, monkeypatch, hot_share):
    monkeypatch.setattr("sluice.operators.skew.HOT_SHARE", hot_share)
    pick = random.Random(9)
    pool = [prose(1, 300), prose(2, 300, 20), prose(3, 250) + " #", "Aa " * 300, "short", "", None, "\t \n", "ÀÉ é" * 90, "A$B"]
    rows = [(i, pick.choice(pool), pick.choice(["en", "de", None, ""]), "s", 1) for i in range(120)]
    rows += [(None, "short", "en", "s", 1), (None, pool[0], None, "s", 1), rows[5], rows[5], (5, pool[0], "en", "s", 1)]
    rows += [(1000 + i, "one text of a third of all rows", "en", "s", 1) for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS part", "'x' AS hash", "1 AS bits", "2 AS n").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").selectExpr("*", "'x' AS text", "'y' AS lang")
    assert audited(docs, labels) == brute_audit(docs.collect(), LABELS)


def test_audit_of_awkward_rows(spark):
    docs, labels = awkward(spark), spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    assert audited(docs, labels) == brute_audit(docs.collect(), LABELS)
    assert audited(docs, labels.limit(0)) == brute_audit(docs.collect(), [])
    assert filter_audit.audit_filters(empty(spark), labels).collect() == []
