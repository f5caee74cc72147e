"""Exact copies, n-gram links, passages and byte strings against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from sluice.llm import ngram_join
from sluice.llm.compact_windows import least_windows, passages, repeated_passages, unexplained
from sluice.llm.components import components
from sluice.llm.exact_dedup import exact_groups, first_copies
from sluice.llm.ngram_join import first_of_groups, ngram_links
from sluice.llm.suffix_dedup import remove_repeats
from tests.llm.helpers import awkward, documents, empty, prose

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("digits", [32, 1])
def test_exact_groups_survive_hash_collisions(spark, digits):
    texts = ["a b", "a  b", "a\tb", "c", "A b", None, "", " ", "a b "] + [f"t{i % 7}" for i in range(40)]
    same = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for r in exact_groups(documents(spark, texts), hash_digits=digits).collect():
        members = [i for i, t in enumerate(same) if t == same[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (members[0], len(members), r.doc_id == members[0])
        assert r.text_sha256 == hashlib.sha256(same[r.doc_id].encode()).hexdigest()


def test_exact_groups_with_a_hot_text(spark, shuffled_joins):
    docs = documents(spark, ["hot"] * 900 + [f"cold {i}" for i in range(600)])
    rows = exact_groups(docs).collect()
    assert len(rows) == 1500 and sum(r.kept for r in rows) == 601
    assert first_copies(docs).columns == docs.columns and first_copies(docs).count() == 601


def test_exact_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    assert exact_groups(docs).count() == docs.count()
    assert first_copies(docs).columns == docs.columns
    assert exact_groups(empty(spark)).collect() == []


def test_components(spark, staging):
    pick = random.Random(2)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(7, 7), (None, 3)]
    links += [(1000 + i, 1001 + i) for i in range(60)]  # a long chain
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = root(a), root(b)
            low[max(a, b)] = min(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint"), staging).collect()}
    assert found == {n: root(n) for n in found} and set(low) - {n for n in low if root(n) == n} <= set(found)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), staging).collect() == []


def brute_links(texts, size, percent):
    sets = []
    for t in texts:
        w = SPACED.findall((t or "").translate(ASCII_LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def edited(text, seed, n):
    words, pick = text.split(), random.Random(seed)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"edit{pick.randrange(10**6)}"
    return " ".join(words)


def near_copies():
    """Groups around the threshold, one of them large, and passages that many share."""
    texts = [None, "", "one", "ONE", "one two", "a b c", "a b c d", "a b c d"]
    for g in range(12):
        base = prose(100 + g, 30 + 20 * g)
        texts += [edited(base, 10 * g + k, k) for k in range(6)]
    hot = prose(7, 160)
    texts += [edited(hot, 1000 + k, 1 + k % 4) for k in range(320)]
    shared = prose(8, 60)
    texts += [f"{prose(2000 + k, 40)} {shared} {prose(3000 + k, 30)}" for k in range(120)]
    return texts


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_ngram_links_equal_brute_force(spark, size, percent):
    texts = near_copies()
    wanted = brute_links(texts, size, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_links(documents(spark, texts), size, percent).collect()}
    assert [got[i] for i in range(len(texts))] == wanted


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_ngram_links_of_texts_that_common_lines_chain(spark, monkeypatch, size, percent):
    """Where rare and common n-grams look alike, lines of a few texts each tie them all up."""
    monkeypatch.setattr(ngram_join, "COUNTERS", 1 << 10)
    monkeypatch.setattr(ngram_join, "CHUNK", 1 << 8)
    monkeypatch.setattr(ngram_join, "FULL", 4)
    monkeypatch.setattr(ngram_join, "LARGE", 40, raising=False)
    largest, blocks_of = [], ngram_join._blocks

    def seen(clusters, *more):
        largest.append(max(r["count"] for r in clusters.groupBy("cluster").count().collect()))
        return blocks_of(clusters, *more)

    monkeypatch.setattr(ngram_join, "_blocks", seen)
    own = lambda seed, n: prose(seed, n, 10**9)
    texts = [" ".join([own(k, 40), *(own(10_000 + (k + i) % 200, 5) for i in range(6))]) for k in range(200)]
    texts += [own(20_000 + k, 70) for k in range(1800)]
    texts += [edited(texts[k], k, 1) for k in range(0, 400, 10)]
    got = {r.doc_id: r.component_id for r in ngram_links(documents(spark, texts), size, percent).collect()}
    assert [got[i] for i in range(len(texts))] == [label for _, label in brute_links(texts, size, percent)]
    assert sum(got[i] != i for i in got) >= 30 and largest[0] <= 40


def test_ngram_links_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = ngram_links(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[6] == 5 and by_id[4] == 3 and by_id[8] == 7 and by_id[0] == 0 and by_id[1] == 1
    assert first_of_groups(docs).columns == docs.columns
    assert ngram_links(empty(spark)).collect() == []


def brute_removed(texts, length):
    blobs, places = [(t or "").encode() for t in texts], {}
    for b in blobs:
        for i in range(len(b) - length + 1):
            places[b[i : i + length]] = places.get(b[i : i + length], 0) + 1
    out = []
    for b in blobs:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if places[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("length", [40, 400])
def test_removed_bytes_equal_brute_force(spark, length):
    pick = random.Random(3)
    passages = [prose(50 + k, 20 * length // 40) for k in range(6)]
    texts = [None, "", "short", "ab" * 2000, "ab" * 1500 + "x", passages[0], passages[0], "é" * 700]
    for k in range(60):
        parts = [pick.choice(passages), prose(500 + k, 30), passages[k % 6][k:], pick.choice(passages)[: length + k]]
        texts.append(pick.choice(["", " ", "Z"]).join(pick.sample(parts, pick.randrange(1, 5))))
    wanted = brute_removed(texts, length)
    for r in remove_repeats(documents(spark, texts), length).collect():
        spans, kept = wanted[r.doc_id]
        assert ([(s.start, s.end) for s in r.spans], bytes(r.kept)) == (spans, kept), r.doc_id


def test_removed_bytes_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    assert all(bytes(r.kept) == b"" for r in rows if r.doc_id in (5, 6, 11))
    assert remove_repeats(empty(spark)).collect() == []


def test_windows_cover_every_stretch():
    """Each stretch of the width lies in exactly one window that has its smallest token."""
    rng, width = np.random.default_rng(4), 7
    values = (rng.permutation(200).astype(np.uint64) << np.uint64(8)) | np.arange(200, dtype=np.uint64)
    edges = np.array([0, 90, 93, 200])
    l, c, r = least_windows(values, 8, np.repeat(np.arange(3), np.diff(edges)), edges, width)
    for a, b in zip(edges[:-1], edges[1:]):
        for i in range(a, b):
            for j in range(i + width - 1, b):
                inside = (l <= i) & (i <= c) & (c <= j) & (j <= r)
                assert inside.sum() == 1 and c[inside][0] == i + int(np.argmin(values[i : j + 1]))


def test_repeated_passages(spark):
    shared, other = prose(60, 70, 5000), prose(61, 80, 5000)
    texts = [f"{prose(600 + k, 60, 5000)} {shared} {prose(700 + k, 60, 5000)}" for k in range(20)]
    texts += [edited(f"{prose(800, 30, 5000)} {other}", 5, 1), f"{other} {prose(801, 200, 5000)}"]
    texts += [prose(900 + k, 300, 5000) for k in range(20)]  # clean
    texts += [prose(62, 60, 5000)] * 3 + ["too short"] * 2 + [None, ""]
    found = {}
    for r in repeated_passages(documents(spark, texts)).collect():
        found.setdefault(r.doc_id, []).append(r)
        assert r.similarity >= 0.8 and r.end_word - r.start_word >= 50 and r.first_doc <= r.doc_id
    assert set(found) == set(range(22)) | {42, 43, 44}
    for k in range(20):
        assert any(r.start_word <= 62 and r.end_word >= 128 for r in found[k])
        assert {r.first_doc for r in found[k]} == {0}
    assert {r.first_doc for i in (42, 43, 44) for r in found[i]} == {42}


@pytest.mark.parametrize("n_words", [50, 51, 52, 54, 60])
def test_short_passages_with_an_edit_at_each_place(n_words):
    """Found exactly if two stretches of the width are alike enough."""
    width, rng = 46, np.random.default_rng(n_words)

    def alike(one, two):
        for i in range(len(one) - width + 1):
            x = set(one[i : i + width].tolist())
            for j in range(len(two) - width + 1):
                both = len(x & set(two[j : j + width].tolist()))
                if both >= 0.8 * (2 * width - both):
                    return True
        return False

    for place in range(n_words):
        one = rng.integers(0, 1 << 32, 40 + n_words - 4 + 40, dtype=np.uint32)
        two = rng.integers(0, 1 << 32, 30 + n_words - 4 + 50, dtype=np.uint32)
        kept = np.array([not i <= place < i + 5 for i in range(n_words - 4)])
        two[30 : 30 + n_words - 4][kept] = one[40 : 40 + n_words - 4][kept]
        found = passages(one, two, width, 0.8)
        assert bool(found) >= alike(one, two), place
        for a, b, x, y, value in found:
            both = len(set(one[a:b].tolist()) & set(two[x:y].tolist()))
            assert min(b - a, y - x) >= width and value == both / (b - a + y - x - both) >= 0.8

def _words(pick: random.Random, n: int) -> list[str]:
    return [f"w{pick.randrange(100_000)}" for _ in range(n)]


@pytest.mark.parametrize("n_line", [25, 40])
def test_shared_passages_with_an_earlier_text_that_has_a_line_of_them(spark, n_line):
    """The earlier text is first in the groups of the line's tokens and shares too little."""
    pick, texts, expected = random.Random(n_line), [], {}
    for k in range(40):
        passage = _words(pick, 60)
        line = passage[10 : 10 + n_line]
        texts += [_words(pick, 80) + line + _words(pick, 80) for _ in range(1 + k % 2)]
        for _ in range(2):
            expected[len(texts)] = (80, 140)
            texts.append(_words(pick, 80) + passage + _words(pick, 80))
    rows = repeated_passages(documents(spark, [" ".join(t) for t in texts])).collect()
    assert {r.doc_id: (r.start_word, r.end_word) for r in rows} == expected
    assert len(rows) == len(expected)


def test_passages_of_frequent_lines_only(spark):
    """Two texts share two lines in a row, each of which very many others have alone."""
    pick = random.Random(3)
    one, two = _words(pick, 28), _words(pick, 28)
    texts = [_words(pick, 60) + (one, two)[k % 2] + _words(pick, 60) for k in range(60)]
    texts += [_words(pick, 70) + one + two + _words(pick, 70) for _ in range(2)]
    rows = repeated_passages(documents(spark, [" ".join(t) for t in texts])).collect()
    assert {r.doc_id: (r.start_word, r.end_word) for r in rows} == {60: (70, 126), 61: (70, 126)}


def test_recall_of_near_duplicate_passages_against_brute_force(spark):
    """Of texts with a stretch of 50 words that is 0.8 similar to one of another text, 9 in 10 are found."""
    pick, texts = random.Random(11), []
    for k in range(60):
        passage = _words(pick, 90)
        texts.append(_words(pick, 50) + passage[20:45] + _words(pick, 50))
        for _ in range(2):
            copy = list(passage)
            for place in pick.sample(range(90), k % 3):
                copy[place] = "edited" + str(pick.random())
            texts.append(_words(pick, 50) + copy + _words(pick, 50))
    width, numbers, grams = 46, {}, []
    for t in texts:
        grams.append(np.array([numbers.setdefault(tuple(t[i : i + 5]), len(numbers)) for i in range(len(t) - 4)]))
    truth = set()
    for i, x in enumerate(grams):
        for j in range(i):
            same = x[:, None] == grams[j][None, :]
            if same.sum() >= 41:
                sums = np.pad(same.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
                both = sums[width:, width:] - sums[:-width, width:] - sums[width:, :-width] + sums[:-width, :-width]
                if (both * 10 >= 8 * (2 * width - both)).any():
                    truth |= {i, j}
    found = {r.doc_id for r in repeated_passages(documents(spark, [" ".join(t) for t in texts])).collect()}
    assert len(truth) > 80
    assert found <= truth | {i for i in range(len(texts)) if i % 3}
    assert len(found & truth) >= 0.9 * len(truth)


def test_unexplained_stretches():
    """Starts within the windows of all functions are left open unless a passage holds them."""

    def window(left, center, right, function):
        return (center << 32) | ((center - left) << 18) | ((right - center) << 4) | function

    packed = np.array([window(0, 30, 70, 0), window(10, 40, 90, 1)], np.int64)
    others = np.array([7, 9])
    pairs, ranges = unexplained(packed, others, [], 2, 46, 2, 0.8)
    assert pairs == [(0, 1)] and {(a, b) for _, a, b in ranges} == {(10, 26)}
    assert unexplained(packed, np.array([7, 7]), [], 2, 46, 2, 0.8)[0] == []
    assert unexplained(packed, others, [(0, 100)], 2, 46, 2, 0.8) == ([], [])
    pairs, ranges = unexplained(packed, others, [(12, 70)], 2, 46, 2, 0.8)
    assert pairs == [] and {(a, b) for _, a, b in ranges} == {(10, 12), (25, 26)}


def test_repeated_passages_of_awkward_rows(spark):
    assert {r.doc_id for r in repeated_passages(awkward(spark)).collect()} == {5, 6}
    assert repeated_passages(empty(spark)).collect() == []


CLASHING = ("_gone", "_copies", "gone", "row", "id", "known", "copies", "keep_id", "n_kept", "_found", "_key", "text_sha256", "col")


def with_clashes(df):
    return df.selectExpr("*", *(f"'clash' AS {name}" for name in CLASHING))


def test_first_copies_are_told_apart_by_id_and_text(spark):
    rows = [
        (1, "a a"), (2, "a a"), (2, "unique text"), (3, "c"), (3, "c"), (None, "c"), (None, "n"), (None, "n"),
        (4, None), (5, ""), (6, " "), (7, "only"), (None, "alone"),
    ]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = first_copies(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    wanted = [(1, "a a"), (2, "unique text"), (3, "c"), (None, "n"), (4, None), (6, " "), (7, "only"), (None, "alone")]
    assert got == sorted(wanted, key=repr)
    assert first_copies(docs.limit(0)).collect() == []


def test_kept_is_never_null(spark):
    rows = exact_groups(spark.createDataFrame([(None, "x"), (None, "x"), (1, "y"), (None, "y")], "doc_id bigint, text string"))
    assert sorted((str(r.doc_id), r.kept) for r in rows.collect()) == [("1", True), ("None", False), ("None", True), ("None", True)]


def test_first_of_groups_with_awkward_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (9, text + " more"), (9, "else"), (None, text), (7, None), (7, "")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, [(5, text), (None, text), (7, None), (7, "")]))
    assert first_of_groups(docs.limit(0)).collect() == []
