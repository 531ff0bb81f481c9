"""Codec, classifier, language, fingerprints: exact round trips, brute force and held-out accuracy."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import language_id, order_minhash, quality_classifier, sentencepiece_codec

from .cases import PLAIN, ROWS, frame, syllables


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.model_path())


def test_codec_equals_the_library(library):
    codec = sentencepiece_codec.codec(sentencepiece_codec.model_path())
    r = random.Random(0)
    odd = " ▁ab\n\té🙂ñ​\x00ThE1.,  "
    texts = ["", " ", "  a  b ", "a\nb\tc", "▁x", "ﬁ①", "\r\n", " " * 37 + "x" + " " * 15 + "\n" + " " * 16, "a" * 500, "ab" * 300, *(t or "" for _, t in ROWS)]
    texts += ["".join(r.choice(odd) for _ in range(r.randint(1, 60))) for _ in range(800)]
    texts += ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 40))) for _ in range(800)]
    for t in texts:
        ids = library.encode(t)
        assert codec.encode(t) == ids
        assert codec.decode(ids) == library.decode(ids) == codec.both(t)[1]


def test_codec_rows(spark, library):
    rows = sentencepiece_codec.encode_decode(frame(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in rows) == sorted((d or 0, library.encode(t or "")) for d, t in ROWS)
    assert sentencepiece_codec.encode_decode(frame(spark, [])).count() == 0
    names = ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")
    for r in sentencepiece_codec.encode_decode(frame(spark), columns=names).collect():
        assert r["n_tokens"] == len(r["ids"]) and r["decoded"] == library.decode(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_codec_remembers_its_words(library):
    codec = sentencepiece_codec.Codec(sentencepiece_codec.model_path())
    made, make = [], codec.words.make
    codec.words.make = lambda text: made.append(text) or make(text)
    words = [f"w{i:x}" for i in range(300_000)]
    for i in [*range(0, len(words), 1000)] * 2:
        codec.coded(" ".join(words[i:i + 1000]))
    assert len(made) == len(words)  # all fit, so each is encoded once
    codec.words.most = 3  # a table that is full all the time
    texts = ["a b c d e f g a", "h i j  a b", " ".join(words[:50])]
    assert [codec.encode(t) for t in texts] == [library.encode(t) for t in texts]


def test_phrases_against_brute_force():
    samples = {"a": "abracadabra abc", "b": "bbbaac cab"}
    model = language_id.build(samples)

    def count(sample, text):
        n = 0
        for i in range(0, len(text), language_id.SEGMENT):
            part = text[i:i + language_id.SEGMENT]
            at = 0
            while at < len(part):
                k = 0
                while at + k < len(part) and part[at:at + k + 1] in sample:
                    k += 1
                at += max(k, 1)
                n += 1
        return n

    r = random.Random(1)
    texts = ["".join(r.choice("abcdr xA") for _ in range(r.randint(0, 300))) for _ in range(200)] + ["ab" * 3000]
    got = language_id.phrases(model, texts)
    assert got.tolist() == [[count(samples[n], t.lower()) for n in ("a", "b")] for t in texts]


def test_languages(spark):
    rows = [(i, syllables(i, 60), "aa") for i in range(60)] + [(100 + i, "".join(random.Random(i).choices("xyzwvq ", k=300)), "bb") for i in range(60)]
    docs = frame(spark, [(d, t) for d, t, _ in rows] + [(900, None), (901, "12 !"), (902, "")])
    docs = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumn("c2", F.when(F.col("c0") < 100, "aa").when(F.col("c0") < 900, "bb")).toDF(*docs.columns)
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert all(got[d]["lang_pred"] == lang for d, _, lang in rows)
    assert all(got[d]["lang_pred"] == "und" and got[d]["score"] == 0 for d in (900, 901, 902))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.identify(frame(spark, [])).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumn(
        "c2", F.lit(None).cast("string")).toDF(*docs.columns)).collect()} == {"und"}


@pytest.mark.parametrize("bound", [language_id.TABLE_BYTES, 1 << 18])
def test_every_language_is_learned(spark, monkeypatch, bound):
    monkeypatch.setattr(language_id, "TABLE_BYTES", bound)
    rows = [(10 * i + k, "".join(random.Random(10 * i + k).choices([chr(0x4E00 + 4 * i + c) for c in range(4)], k=30)), f"l{i:03}")
            for i in range(70) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert (len([*language_id.blocks(language_id.sample(docs))]) > 1) == (bound == 1 << 18)
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert all(got[d]["lang_pred"] == lang and got[d]["rate"] < 0.75 for d, _, lang in rows)


def test_languages_of_every_plane(spark):
    rows = [(i, "".join(random.Random(i).choices(alphabet, k=80)), lang) for i, (lang, alphabet) in enumerate(
        [("aa", "abcdefgh "), ("ff", [chr(0x1E922 + c) for c in range(20)] + [" "]), ("zz", [chr(0x10428 + c) for c in range(20)])] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert all(got[d]["lang_pred"] == lang and got[d]["rate"] < 0.75 for d, _, lang in rows)
    model = language_id.build({"ff": "".join(chr(0x1E922 + c) for c in range(20))})
    upper, lower, other = (np.array([c], np.uint32) for c in (0x1E900, 0x1E922, 0x1F600))
    assert model.read(upper) == model.read(lower) > 0 and model.read(other) == 0 == model.read(np.array([0x10FFFF], np.uint32))


def test_parts_of_a_long_text(spark):
    text = "".join(chr(0x4E00 + i % 20_000) for i in range(50_000))
    got = spark.createDataFrame([(text,), ("short",)], "text string").select(quality_classifier._spread(F.col("text"))).collect()
    part, n = quality_classifier.FIT_PART, quality_classifier.FIT_PARTS
    assert got[0][0] == "".join(text[int(i * (len(text) - part) / (n - 1)):][:part] for i in range(n)) and got[0][0].endswith(text[-part:])
    assert got[1][0] == "short"


def test_quality(spark):
    good = [(i, syllables(i, 80)) for i in range(400)]
    bad = [(1000 + i, " | ".join(syllables(i, 40).split()).upper() + " !!") for i in range(400)]
    docs = frame(spark, good + bad + [(5000, None), (5001, "")])
    labels = spark.createDataFrame([(d, int(d < 1000), 0) for d, _ in good + bad] + [(None, 1, 0), (7, None, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.learn(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.classify(docs, model).collect()}
    assert np.mean([(got[d] >= 0.7) == (d < 1000) for d, _ in good + bad if quality_held(d)]) > 0.95
    assert got[5000] == got[5001] == model.prior and all(0 <= s <= 1 for s in got.values())
    empty = quality_classifier.learn(docs, labels.limit(0))
    assert empty.prior == 0.5 and quality_classifier.score(empty, PLAIN) == 0.5
    assert quality_classifier.classify(frame(spark, []), model).count() == 0


def quality_held(doc_id: int) -> bool:
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def _slow_sketch(text: str) -> list[int]:
    """Order MinHash read off its definition, with the module's item hashes."""
    x = order_minhash.items(order_minhash.text_codes(text))
    out = []
    for m in order_minhash._MULTIPLIERS:
        with np.errstate(over="ignore"):
            hashed = x * m
        chosen = sorted(sorted(range(len(x)), key=lambda i: (hashed[i], i))[:order_minhash.TUPLE])
        value = np.array([1], np.uint64)
        with np.errstate(over="ignore"):
            for i in chosen:
                value = order_minhash._mixed((value ^ x[i]) * order_minhash._GOLDEN)
        out.append(int(value[0] >> np.uint64(32)))
    return out


def test_sketch(monkeypatch):
    monkeypatch.setattr(order_minhash, "PIECE", 50)
    for text in (PLAIN, "abc", "a" * 300, syllables(3, 40)):
        assert order_minhash.sketch(order_minhash.text_codes(text)).tolist() == _slow_sketch(text)
    # Occurrence numbers tell repeats apart, order tells moved parts apart.
    assert len({*order_minhash.items(order_minhash.text_codes("abcdefgh" * 9)).tolist()}) == 65
    a, b = syllables(1, 100), syllables(2, 100)
    s = [order_minhash.sketch(order_minhash.text_codes(t)) for t in (a + " " + b, b + " " + a, a + " " + b)]
    assert order_minhash.likeness(s[0], s[2]) == 1 > order_minhash.likeness(s[0], s[1])


@pytest.mark.parametrize("parts", [1, 7])
def test_fingerprints(spark, parts):
    rows = [(i * 3, syllables(i, 1 + i % 40)) for i in range(60)] + ROWS
    got = order_minhash.fingerprints(frame(spark, rows).repartition(parts)).collect()
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = []
    for k, (d, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(t) // 4
        edited = t[:len(t) - n] + following[:n]
        a, b, c = (order_minhash.sketch(order_minhash.text_codes(x)) for x in (t, edited, following))
        want.append((d or -1, len(t), hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
                     order_minhash.likeness(a, b), order_minhash.likeness(a, c)))
    assert sorted((r["doc_id"] or -1, *r[1:]) for r in got) == sorted(want)


def test_fingerprints_of_few_rows(spark):
    assert order_minhash.fingerprints(frame(spark, [])).count() == 0
    only = order_minhash.fingerprints(frame(spark, [(1, PLAIN)])).collect()
    assert len(only) == 1 and only[0]["near_next"] == 1
