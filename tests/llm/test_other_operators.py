"""Neighbours, chat windows, mixing, and the pipeline."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm.chat import conversation_digests, escaped, format_conversations, read_back, unescaped
from sluice.llm.mixing import fit_rates, mix_to_targets, mixed
from sluice.llm.multi_index import Codebooks, kmeans, nearest
from sluice.sources.staging import Staging
from tests.llm.helpers import awkward, documents, empty, prose

VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_cells_are_visited_in_order_of_the_sum():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 6))
    books = Codebooks(kmeans(points[:, :3], 8), kmeans(points[:, 3:], 8))
    query = rng.normal(size=6)
    one, two = books.first @ query[:3], books.second @ query[3:]
    order = list(books.visit(query))
    sums = [one[c // 8] + two[c % 8] for c in order]
    assert sorted(order) == list(range(64)) and all(a >= b - 1e-12 for a, b in zip(sums, sums[1:]))


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 16))
    points = (centers[rng.integers(0, 12, 3000)] + 0.5 * rng.normal(size=(3000, 16))).astype(np.float32)
    points[50:90] = points[50]  # ties, queries among them
    rows = [(i, [float(x) for x in p], 0) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, VECTORS)
    hits = wanted = 0
    by_query = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0).collect():
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    exact = points.astype(np.float64)
    for q in range(0, 3000, 20):
        found = sorted(by_query[q])
        assert [f[0] for f in found] == list(range(1, 21)) and q not in {f[1] for f in found}
        assert np.allclose([exact[v] @ exact[q] for _, v, _ in found], [s for *_, s in found], atol=1e-12)
        assert [f[1:] for f in found] == sorted((f[1:] for f in found), key=lambda f: (-f[1], f[0]))
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        hits, wanted = hits + len(set(best) & {f[1] for f in found}), wanted + 20
    assert hits >= 0.9 * wanted


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0),
            (6, [None, 1.0], 0), (7, [], 0), (8, [1.0], 0), (20, [1.0, 0.0], 0), (20, [1.0, 0.0], 0), (40, None, 0), (9, [-1.0, -0.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("cell", F.lit("clash")).withColumn("rep", F.lit(1))
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert found == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (0, 3, 9, -1.0), (20, 1, 0, 1.0), (20, 2, 1, 0.5), (20, 3, 9, -1.0)]
    assert nearest(df.where("vec_id IN (1, 9)"), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


TURNS = "conv_id bigint, turn bigint, role string, text string"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "[\\\\/INST]", "<\\\\/s>", "\\", "<", "[", "s>", "INST]", "\n"]


def conversations():
    pick = random.Random(9)
    rows = []
    for conv in range(40):
        for turn in range(pick.randrange(1, 30)):
            role = "system" if turn == 0 and conv % 3 == 0 else pick.choice(["user", "assistant", "tool", None])
            body = "".join(pick.choices([*CONTROL, "é", "word ", "\U0001f600"], k=pick.randrange(40)))
            rows.append((conv, turn, role, pick.choice([None, "", body, body * 20])))
    return [*rows, rows[0], (None, None, None, None), (99, 1, "assistant", "x" * 20_000)]


def test_escaping_is_reversible(spark):
    pick = random.Random(8)
    texts = ["".join(pick.choices(CONTROL, k=12)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escaped(F.col("t")))
    for r in df.withColumn("u", unescaped(F.col("e"))).collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL[:4])


@pytest.mark.parametrize(("budget", "history"), [(2048, 512), (60, 20), (1, 0)])
def test_conversations_come_back_from_their_windows(spark, budget, history):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).withColumn("window", F.lit("clash"))
    windows = format_conversations(df, budget, history)
    found = {r.conv_id: r for r in conversation_digests(windows).collect()}
    by_conv = {}
    for row in sorted(rows, key=lambda r: tuple((x is not None, x) if i < 2 else (True, x or "") for i, x in enumerate(r))):
        by_conv.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        got = found[conv]
        assert got.n_turns == len(turns) and got.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got.loss_chars == len(loss) and got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert found[99].formatted_chars == 20_000 + len("<s>assistant[INST][/INST]</s>")


def test_windows_repeat_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k, ["assistant", "user"][k % 2], f"turn {k} " + "x" * 70) for k in range(1, 40)]
    windows = sorted(format_conversations(spark.createDataFrame(rows, TURNS), 200, 60).collect(), key=lambda r: r.window)
    assert len(windows) > 3
    assert all(w.formatted.startswith("<s>system[INST]be kind") for w in windows)
    assert all(w.n_repeated == (2 if i else 0) + (1 if i else 0) or i == 0 for i, w in enumerate(windows))
    assert all(w.n_tokens <= 200 + 30 for w in windows)
    back = read_back(format_conversations(spark.createDataFrame(rows, TURNS), 200, 60)).orderBy("window").collect()
    assert [t.text for w in back for t in w.turns] == [r[3] for r in rows]
    assert format_conversations(spark.createDataFrame([], TURNS)).collect() == []


def mixture(spark):
    pick = random.Random(3)
    kinds = {"en": "the of stone river and".split(), "de": "und der stein fluss mit".split(), "fr": "la les et pierre que".split()}
    rows = []
    for i in range(600):
        lang = pick.choices(list(kinds), [0.7, 0.2, 0.1])[0]
        rows.append((i, " ".join(pick.choices(kinds[lang], k=pick.randrange(20, 80))), lang, "s", 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows) if i % 3 == 0], "doc_id bigint, domain string")
    return docs, labels


def test_mixture_meets_its_targets(spark):
    docs, labels = mixture(spark)
    targets = {"en": 0.4, "de": 0.3, "fr": 0.3}
    rows = mix_to_targets(docs, labels, targets).collect()
    assert len(rows) == 600 and all(r.rate >= 0 for r in rows)
    total = sum(r.tokens * r.rate for r in rows)
    for lang, weight in targets.items():
        assert abs(sum(r.tokens * r.rate for r in rows if r.domain == lang) / total - weight) < 0.02
    assert sum(r.domain == r.asDict()["lang"] for r in rows) > 590
    assert all(abs(r.copies - r.rate) < 1 for r in rows)


def test_least_rate_keeps_every_document(spark):
    docs, labels = mixture(spark)
    plan = mix_to_targets(docs, labels, {"en": 0.4, "de": 0.3, "fr": 0.3}, least_rate=1.0, scale=None)
    out = mixed(docs, plan)
    assert out.columns == docs.columns and out.select("doc_id").distinct().count() == 600
    assert out.count() == plan.agg(F.sum("copies")).first()[0] > 600


def test_overlapping_domains_meet_their_targets(spark):
    """Two domains that share their words, and a third one that is not wanted."""
    pick = random.Random(12)
    kinds = {"a": [3, 2, 0], "b": [2, 3, 0], "c": [0, 0, 1]}
    rows = []
    for i in range(900):
        lang = pick.choice(list(kinds))
        words = pick.choices([" the ", " of ", " und "], kinds[lang], k=12)
        rows.append((i, "x".join(words), lang, "s", 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = docs.where("doc_id % 2 = 0").selectExpr("doc_id", "lang AS domain")
    found = mix_to_targets(docs, labels, {"a": 0.6, "b": 0.4}).collect()
    assert {r.deviation for r in found} == {found[0].deviation} and found[0].deviation < 1e-3
    assert all(r.domain == "c" and r.rate < 0.01 for r in found if r.asDict()["lang"] == "c")
    total = sum(r.tokens for r in found)
    assert abs(sum(r.tokens * r.rate for r in found) / total - 1) < 1e-3
    (far,) = {r.deviation for r in mix_to_targets(docs, labels, {"a": 0.6, "b": 0.4}, least_rate=1.0).collect()}
    assert far > 0.1


@pytest.mark.parametrize(("floor", "goals"), [(0.0, [3000.0, 1000.0, 1000.0]), (0.8, [100.0, 9000.0, 500.0]), (0.0, [4000.0, 1000.0, 500.0])])
def test_rates_are_a_least_squares_optimum(spark, floor, goals):
    """Against coordinate descent, which sets one document's rate at a time to its best value."""
    pick = np.random.default_rng(5)
    p = pick.dirichlet([0.5, 0.5, 0.5], 60)
    p[:20] = [0.5, 0.3, 0.2]
    tokens = pick.integers(0, 200, 60)
    members = spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(tokens, p)], "tokens bigint, p0 double, p1 double, p2 double")
    goals, parts = np.array(goals), p * tokens[:, None]
    mass = parts.sum(0)
    found, reached = fit_rates(members, ["p0", "p1", "p2"], mass, goals, floor, Staging(spark))
    rows = found.collect()
    assert len(rows) == 60 and all(r.rate >= floor for r in rows)
    again = sum(np.array([r.p0, r.p1, r.p2]) * r.tokens * r.rate for r in rows)
    assert np.allclose(again, reached)
    weights = 1 / np.maximum(np.maximum(mass, goals / 100), 1.0)
    rate = np.full(60, max(floor, 1.0))
    for _ in range(3000):
        for i in np.flatnonzero(tokens):
            left = goals - (rate @ parts - rate[i] * parts[i])
            rate[i] = max(floor, (weights * parts[i]) @ left / ((weights * parts[i]) @ parts[i]))
    best, cost = weights @ (rate @ parts - goals) ** 2, weights @ (reached - goals) ** 2
    assert cost <= best * 1.001 + 1e-3


def test_mixing_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(3, "a"), (5, "b"), (7, "a"), (77, "b"), (None, "a"), (8, None)], "doc_id bigint, domain string")
    rows = mix_to_targets(docs, labels, {"a": 0.5, "b": 0.5, "c": 1.0}).collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 for r in rows)
    assert {r.rate for r in mix_to_targets(docs, labels.limit(0), {"a": 1.0}).collect()} == {1.0}
    assert mix_to_targets(empty(spark), labels, {"a": 1.0}).collect() == []


def test_pipeline_stages(spark, tmp_path):
    pick = random.Random(11)
    calm = [prose(10_000 + k, pick.randrange(20, 200), 3000) for k in range(150)]
    texts = calm + calm[:20] + [t + " end" for t in calm[20:40]] + [f"{t} zorgid flemmux" for t in calm[40:100]] + [None, "", "one"]
    docs = documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 1, int(170 + 20 <= i < 250)) for i in range(250)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, ids = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        if name != "bpe":
            assert kept.columns == docs.columns
        ids[name] = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids["toxicity"] & set(range(190, 250)) and set(range(150)) <= ids["toxicity"]
    assert not ids["exact_dedup"] & set(range(150, 170)) and set(range(150)) <= ids["exact_dedup"]
    assert set(range(150)) <= ids["ngram_join"] and len(ids["ngram_join"] & set(range(170, 190))) < 10
    assert ids["mixing"] == ids["bpe"] == ids["ngram_join"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= len(ids["bpe"])


def test_mixed_rows_with_awkward_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d"), (3, None), (9, "e")], "doc_id bigint, text string")
    docs = docs.selectExpr("*", *(f"'clash' AS {name}" for name in ("_copies", "copies", "_id", "known", "row", "id", "_copy", "col")))
    plan = spark.createDataFrame([(1, 2), (1, 1), (None, 3), (2, 0), (3, 1)], "doc_id bigint, copies bigint")
    got = mixed(docs, plan)
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(
        map(str, [(1, "a")] * 2 + [(1, "b")] * 2 + [(None, "c")] * 3 + [(3, None)])
    )
    assert mixed(docs.limit(0), plan).collect() == [] == mixed(docs, plan.limit(0)).collect()


def test_pipeline_without_labels(spark, tmp_path):
    """Nothing is known to be toxic and no language is told apart: only copies go."""
    text = " ".join(f"w{i}" for i in range(40))
    documents(spark, [text, text, "other words", None, ""]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == [0, 2, 3]
