"""Licence scans, byte-pair encoding, toxicity: one result row per document."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import bpe, licenses, toxicity
from tests.llm.helpers import awkward, documents, empty, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def codec():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def samples():
    pick = random.Random(5)
    letters = ["ab ", "the and ing\n", "é一\U0001f600 a1.", "=-_*# \n\t", "'st 're"]
    drawn = ["".join(pick.choice(pick.choice(letters)) for _ in range(pick.randrange(80))) for _ in range(300)]
    fixed = [
        "", " ", "  a   b \n\n c ", "it's we'll I'D", "a<|endoftext|> b<|endoftext|>", "\x1c\x85　x", "Ã" * 700 + "-" * 400,
        "a" * 3000, "zyxw" * 900, "½ Ⅷ 123", "Ᲊ ՘a", "tail ", "\r\n\r\n x",
    ]
    return fixed + drawn


def test_encoding_equals_the_library(codec, library):
    for text, ids in zip(samples(), codec.encode_all(samples())):
        assert ids.decode() == ",".join(map(str, library.encode(text, add_special_tokens=False).ids)), text


def test_decoding_equals_the_library(codec, library):
    pick = random.Random(6)
    for _ in range(100):
        ids = [pick.randrange(50257) for _ in range(pick.randrange(30))]
        wanted = library.decode(ids, skip_special_tokens=False)
        assert "".join(codec.decode(",".join(map(str, ids)).encode())) == wanted


def test_long_stretches_need_constant_memory(codec):
    """Tokens that left the buffer are the ones of the whole stretch."""
    merges = codec.merges
    data = ("ainotehsr" * 2000).encode()
    assert list(merges.encode(data)) == list(merges.encode(data[: len(data)]))
    short = data[:31]
    alike = [[t for t in ids if t >= 0] for ids in merges.encode_alike([short, short[::-1]])]
    assert alike == [list(merges.encode(short)), list(merges.encode(short[::-1]))]


def test_text_machine_holds_back_unfinished_characters():
    data = "é漢\U0001f600a".encode() + b"\xff\xe6\xbc" + "z".encode() + b"\xf0\x9f"
    machine = bpe.Utf8Machine()
    parts = [machine.feed(data[i : i + 1]) for i in range(len(data))] + [machine.finish()]
    assert "".join(parts) == data.decode("utf-8", "replace")


def test_encoded_documents(spark, library):
    docs = awkward(spark)
    rows = bpe.encode_documents(docs, PATH).collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.encode_documents(empty(spark), PATH).collect() == []


def brute_licenses(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    at, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_scan_equals_brute_force(spark):
    pick = random.Random(1)
    pool = "gnu general public License mit MIT, apache cc-by é by cc license x1 GNU\tGeneral".split(" ")
    texts = [" ".join(pick.choices(pool, k=pick.randrange(40))) for _ in range(300)]
    texts += ["mit license mit license", None, "", "cc by cc by", prose(3, 50_000) + " Apache\nLicense"]
    for r in licenses.scan_licenses(documents(spark, texts)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert licenses.scan_licenses(awkward(spark)).count() == awkward(spark).count()
    assert licenses.scan_licenses(empty(spark)).collect() == []


@pytest.mark.parametrize(
    ("text", "permitted", "leaves"),
    [
        ("MIT", True, {"mit"}),
        ("MIT OR GPL-2.0-only", True, {"mit", "gpl-2.0-only"}),
        ("MIT AND GPL-2.0-only", False, {"mit", "gpl-2.0-only"}),
        ("GPL-2.0 AND MIT OR ISC", True, {"gpl-2.0", "mit", "isc"}),
        ("GPL-2.0 AND (MIT OR ISC)", False, {"gpl-2.0", "mit", "isc"}),
        ("Apache-2.0 WITH LLVM-exception", True, {"apache-2.0"}),
        ("MIT */", True, {"mit"}),
    ],
)
def test_license_expressions(text, permitted, leaves):
    parsed = licenses.parse_expression(text)
    assert parsed.permitted(licenses.PERMISSIVE) == permitted and parsed.leaves() == leaves


@pytest.mark.parametrize("text", ["", "(MIT", "MIT AND", "OR MIT", "MIT WITH", "()", "AND"])
def test_broken_license_expressions(text):
    assert licenses.parse_expression(text) is None


def test_tags_add_labels(spark):
    text = "// SPDX-License-Identifier: MIT OR GPL-2.0-only\n# spdx-license-identifier: (ISC\n"
    (row,) = licenses.scan_licenses(documents(spark, [text])).collect()
    assert row.labels == "gpl-2.0-only,mit" and row.expressions == ["MIT OR GPL-2.0-only"] and row.permitted


@pytest.mark.parametrize("sign", ["AND", "OR"])
def test_long_license_expressions_are_read_to_their_end(spark, sign):
    names = [f"LicenseRef-{k}" for k in range(3000)]
    flat, nested = f" {sign} ".join([*names, "MIT"]), "(" * 3000 + f" {sign} ".join(["ISC", *(f"{n})" for n in names)])
    docs = documents(spark, [f"SPDX-License-Identifier: {e}\nmore" for e in (flat, nested)])
    for row, own, text in zip(scan_sorted(docs), ("mit", "isc"), (flat, nested)):
        assert set(row.labels.split(",")) == {own, *(n.lower() for n in names)}
        assert row.expressions == [text] and row.permitted == (sign == "OR")


def scan_sorted(docs):
    return sorted(licenses.scan_licenses(docs).collect(), key=lambda r: r.doc_id)


def toxic_corpus(spark):
    pick = random.Random(4)
    calm = ["river", "stone", "garden", "paper", "window", "summer", "music", "letter"]
    harsh = ["zorgid", "flemmux", "krottish"]
    texts, marks = [], []
    for i in range(400):
        words = pick.choices(calm, k=pick.randrange(5, 60))
        toxic = i % 4 == 0
        if toxic:
            words.insert(pick.randrange(len(words)), pick.choice(harsh) + pick.choice(["", "s", "er"]))
        texts.append(" ".join(words))
        marks.append(int(toxic))
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks)], "doc_id bigint, toxic int")
    return documents(spark, texts), labels, marks


def test_toxicity_on_held_out_documents(spark):
    docs, labels, marks = toxic_corpus(spark)
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == marks[r.doc_id] for r in held) >= 0.97 * len(held)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_held_out_labels_and_other_columns_teach_nothing(spark):
    docs, labels, _ = toxic_corpus(spark)
    score = lambda d, t: {r.doc_id: r.score for r in toxicity.score_toxicity(d, t).collect()}
    plain = score(docs, labels)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert score(docs.selectExpr("doc_id", "text", "'x' AS lang"), turned) == plain


def test_toxicity_of_awkward_rows(spark):
    docs, labels, _ = toxic_corpus(spark)
    both = awkward(spark)
    rows = toxicity.score_toxicity(both.select(docs.columns).unionAll(docs.selectExpr("doc_id + 100", "text", "lang", "source", "n_chars")),
                                   labels.selectExpr("doc_id + 100 AS doc_id", "toxic")).collect()
    assert len(rows) == both.count() + docs.count()
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score_toxicity(both, none).collect()} == {0.0}
    assert toxicity.without_toxic(both, none).count() == both.count()
    assert toxicity.score_toxicity(empty(spark), labels).collect() == []


def test_models_are_distributions():
    import numpy as np

    kinds = np.random.default_rng(1).integers(0, 3, (toxicity.SYMBOLS,) * 3)
    kinds[5] = 0
    assert np.allclose(toxicity.continuation(kinds).sum(-1), 1)


def test_every_character_is_encoded_as_in_the_library(codec, library):
    every = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x110000)]]
    lines = ["".join(f"{c}'t a{c} 1{c}2 {c}{c}\n" for c in every[k : k + 400]) for k in range(0, len(every), 400)]
    pick = random.Random(2)
    odd = "".join(codec.odd.values()) + "é'ta1 \n"
    lines += ["".join(pick.choice([pick.choice(odd), pick.choice(every), "'t", " "]) for _ in range(20)) for _ in range(20_000)]
    wanted = library.encode_batch(lines, add_special_tokens=False)
    different = [text for text, ids, e in zip(lines, codec.encode_all(lines), wanted) if ids.decode() != ",".join(map(str, e.ids))]
    assert not different, different[0][:80]
