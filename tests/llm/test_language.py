from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from waymark.llm import language
from waymark.llm.tokens import groups

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in out if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in out) <= 0.01 * len(out)


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
    "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa.",
    "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है।",
    "xkcd qwrt zzpq mnbv lkjh gfds ptrw vbnm qzxc wrtp lkjg hgfd",
    "d41d8cd98f00b204e9800998ecf8427e 0cc175b9c0f1b6a831c399e269772661 92eb5ffee6ae2fec3ad71c777531578f",
]


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs)
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(FOREIGN)], DOCS)
    told = {r.doc_id: (r.rejected, r.lang_pred, r.score) for r in language.identify(rows, model).collect()}
    assert sum(told[i][0] for i in told) >= 0.9 * len(FOREIGN), told
    own = language.identify(docs, model).where("lang_pred != 'und'").collect()
    assert sum(not r.rejected for r in own) >= 0.99 * len(own)


def py_probabilities(model, text):
    """Subwords, buckets, mean and softmax of one text, one by one."""
    import math
    import unicodedata

    kept = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text)
    data = re.sub("[A-Z]", lambda m: m[0].lower(), kept).encode()
    places = []
    for size in language.GRAMS:
        for at in range(len(data) - size + 1):
            gram = data[at : at + size]
            if 32 in gram[1:-1] or (gram[0] == 32 and gram[-1] == 32):
                continue
            places.append((int.from_bytes(gram, "big") * language.MULTIPLIERS[size] & 0xFFFFFFFF) >> 17)
    logits = [(sum(model.scores[b, k] for b in places) / len(places) + model.bias[k]) / model.temperature for k in range(len(model.bias))]
    top = max(logits)
    total = sum(math.exp(x - top) for x in logits)
    return [math.exp(x - top) / total for x in logits[:-1]]


def test_probabilities_match_brute_force(spark, sf):
    model = language.train(spark.read.parquet(f"{sf}/documents.parquet"))
    said = ["The end – and THE «début» of it… 12×3", "é", "a b", "für ÜBER 42 and日本語、テスト😀 x", "mañana " * 200]
    _, _, texts = next(groups(pa.array(said)))
    got, _ = model.probabilities(texts)
    assert np.allclose(got, [py_probabilities(model, t) for t in said])


def test_a_text_of_20_mb(spark, sf):
    """Pieces give the same probabilities as the whole, and memory doesn't follow 60 times the text."""
    import tracemalloc

    model = language.train(spark.read.parquet(f"{sf}/documents.parquet"))
    part = "der und die ünd 漢字 " * 50
    _, _, small = next(groups(pa.array([part])))
    _, _, large = next(groups(pa.array([part * (20_000_000 // len(part.encode()))])))
    tracemalloc.start()
    got = model.probabilities(large)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, model.probabilities(small)[0], atol=0.01) and peak < 200_000_000


def test_edge_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.train(docs)
    edge = spark.createDataFrame(
        [
            (1, None, "en", None, None),
            (2, "", "en", None, None),
            (3, "12 34 !!", "en", None, None),
            (None, "the and of it is", None, None, None),
            (5, "der und die " * 300_000, None, None, None),
            (5, "der und die " * 300_000, None, None, None),
            (6, "é", None, None, None),
        ],
        DOCS,
    )
    got = [(r.doc_id, r.lang_pred) for r in language.identify(edge, model).collect()]
    assert got[:6] == [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "de"), (5, "de")]
    assert got[6][1] in model.languages


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, "some text", None, None, None)], DOCS)
    assert language.train(rows) is None
    assert [r.lang_pred for r in language.identify(rows, None).collect()] == ["und"]
    assert language.identify(rows.limit(0), None).count() == 0


def test_labels_are_no_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    model = language.train(docs)
    bare = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x"))
    a, b = (sorted(map(tuple, language.identify(d, model).collect())) for d in (docs, bare))
    assert a == b


def test_no_language_is_left_out(spark):
    rows = [(8 * k + i, f"w{k:03d} " * 3, f"l{k:03d}", None, None) for k in range(210) for i in range(8)]
    rows += [(2_000 + i, "foo bar baz " * 20, "short", None, None) for i in range(40)]
    rows += [(3_000 + i, "schöne grüße " * 2_000, "long", None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    assert docs.where(F.length("text") > language.MAX_CHARS).count() == 40
    lengths = language.sampled(docs).select(F.max(F.length("text"))).first()[0]
    model = language.train(docs)
    assert lengths == language.MAX_CHARS and set(model.languages) == {r[2] for r in rows}
    model = language.train(docs.where("doc_id >= 2000"))
    got = {r.doc_id: r.lang_pred for r in language.identify(docs.where("doc_id >= 2000"), model).collect()}
    assert got == {r[0]: r[2] for r in rows if r[0] >= 2_000}


def test_the_sample_is_bounded_in_characters(spark, monkeypatch):
    rows = [(i, "schöne grüße " * 400, f"l{i % 3}", None, None) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(language, "CHARS", 200_000)
    got = [len(r.text) for r in language.sampled(docs).collect()]
    assert len(got) >= 250 and sum(got) <= 200_000 and min(got) > language.EXCERPT_CHARS[1]
    monkeypatch.setattr(language, "CHARS", 1_000)
    assert {len(r.text) for r in language.sampled(docs).collect()} == {language.EXCERPT_CHARS[1]}


def test_training_on_texts_of_few_subwords_stays_finite():
    rows = [(f"l{k:02d}", np.array([k, 100 + k]), np.array([3.0, 1.0])) for k in range(26) for _ in range(12)]
    rows += [(None, np.array([500 + i % 40]), np.array([2.0])) for i in range(120)]
    with np.errstate(over="raise", invalid="raise", divide="raise"):
        model = language.fit(rows)
    assert np.isfinite(model.scores).all() and np.isfinite(model.bias).all()
    told = (model.scores[[[k, 100 + k] for k in range(26)]] * np.array([0.75, 0.25])[:, None]).sum(1) + model.bias
    assert [model.languages[i] for i in told[:, :-1].argmax(1)] == [f"l{k:02d}" for k in range(26)]


def test_thresholds_of_certain_rows_stay_below_one():
    own, other = np.ones(50), np.full(50, 0.2)
    assert 0.2 < language.threshold_of(own, other) < 1
    rng = np.random.default_rng(1)
    rows = [(lang, np.arange(at, at + 300), np.ones(300)) for at, lang in ((0, "a"), (400, "b"), (800, None)) for _ in range(60)]
    rows = [(lang, rng.choice(buckets, 200, replace=False), counts[:200]) for lang, buckets, counts in rows]
    assert (language.fit(rows, epochs=12).thresholds < 1).all()
