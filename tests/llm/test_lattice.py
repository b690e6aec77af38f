from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from waymark.llm import lattice as L

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def pieces():
    return L.Pieces(L.VOCABULARY)


def all_cuts(pieces, logp, word):
    """Sum over every way to cut the word, by enumeration."""
    ids = {}
    for key, i in zip(pieces.keys.tolist(), pieces.ids.tolist()):
        if i >= 0:
            ids[key] = i
    data = b" " + word

    def rest(at):
        if at == len(data):
            return 1.0
        total = math.exp(logp[pieces.byte_id[data[at]]]) * rest(at + 1)
        for end in range(at + 1, len(data) + 1):
            piece = ids.get(L.Pieces.key(data[at:end]))
            if piece is not None:
                total += math.exp(logp[piece]) * rest(end)
        return total

    return math.log(rest(0))


def test_forward_sums_every_cut(pieces):
    logp = np.log(pieces.prior + 1e-30)
    words = [b"the", b"a", "é".encode(), b"reading", b"xqz", "Ωmega".encode(), b"tion"]
    got, expected = L.lattice(pieces, logp, words, np.ones(len(words)))
    assert np.allclose(got, [all_cuts(pieces, logp, w) for w in words])
    assert expected.sum() >= len(words)
    longer = [b"ab" * 700, b"the"] + words
    assert np.allclose(L.lattice(pieces, logp, longer)[0][1:], [all_cuts(pieces, logp, w) for w in [b"the"] + words])


def test_long_words_in_parts(pieces, monkeypatch):
    """Part by part a word has the score and the expected pieces that it has as a whole."""
    logp = np.log(pieces.prior + 1e-30)
    words = [("reading" * 40 + "Ωmega" * 30).encode(), b"x" * 300, b"tion"]
    want, counts = L.lattice(pieces, logp, words, np.array([2.0, 1.0, 3.0]))
    monkeypatch.setattr(L, "ALONE", 0)
    monkeypatch.setattr(L, "PART", 17)
    got, own = L.lattice(pieces, logp, words, np.array([2.0, 1.0, 3.0]))
    assert np.allclose(got, want) and np.allclose(own, counts)


def test_a_word_of_300_kb(spark, pieces):
    import tracemalloc

    word = bytes(np.random.default_rng(1).integers(97, 123, 300_000, dtype=np.uint8))
    logp = np.log(pieces.prior + 1e-30)
    tracemalloc.start()
    total, expected = L.lattice_of_long(pieces, logp, word, 1.0)
    assert tracemalloc.get_traced_memory()[1] < 50_000_000 and total < 0 and expected.sum() > 75_000
    tracemalloc.stop()


def test_scores_match_the_pieces(spark, sf, pieces):
    """The score of a document is the sum over its words and the end, under the fitted probabilities."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = Counter()
    ends = 0
    for r in docs.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update(w.encode() for w in WORD.findall(lower(r.text or "")))
            ends += 1
    prior = p = pieces.prior
    with np.errstate(divide="ignore"):
        for _ in range(L.ROUNDS):
            words, n = zip(*sorted(counts.items()))
            expected = L.lattice(pieces, np.log(p), list(words), np.array(n, float))[1]
            p = (expected + L.PRIOR * prior) / (expected.sum() + L.PRIOR)
        end = (ends + 1) / (ends + 1 + expected.sum() + L.PRIOR)
        logp = np.log(p * (1 - end))
    for r in L.score_documents(docs).join(docs.select("doc_id", "text"), "doc_id").limit(60).collect():
        own = [w.encode() for w in WORD.findall(lower(r.text or ""))]
        want = (math.log(end) + L.lattice(pieces, logp, own)[0].sum()) / math.log(10)
        assert math.isclose(r.score, want, rel_tol=1e-6), r.doc_id


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_base_columns_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(
        spark.createDataFrame(
            [
                (-1, None, None, None, None),
                (-2, "", None, None, None),
                (-3, "THE the Thé " + "x" * 3000, None, None, None),
                (-3, "THE the Thé " + "x" * 3000, None, None, None),
                (None, "the held out one", None, None, None),
            ],
            DOCS,
        )
    )
    rows = [(r.doc_id, [*WORD.findall(lower(r.text or "")), None]) for r in docs.collect()]
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(t for (_, tokens), h in zip(rows, held) if not h for t in tokens)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), h, len(t), sum(counts[x] > 0 for x in t), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t), 4))
        for (i, t), h in zip(rows, held)
    )
    out = L.score_documents(docs).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out)
    assert got == want
    assert all(r.score < 0 for r in out)
    # learning makes documents that were held out likelier than the vocabulary's order alone does
    untrained = L.score_documents(docs, rounds=0).collect()
    total = lambda rows: sum(r.score for r in rows if r.held_out)
    assert total(out) > 0.9 * total(untrained)


def test_pieces_add_up_to_one(spark, sf, pieces):
    docs = spark.createDataFrame([(i, "to be or not to be", None, None, None) for i in range(20)], DOCS)
    counts = spark.createDataFrame([(b"to", 40), (b"be", 40), (b"or", 20), (b"not", 20)], "word binary, c bigint")
    logp, end = L.fit_pieces(counts, docs.count(), L.VOCABULARY)
    assert abs(np.exp(logp).sum() + math.exp(end) - 1) < 1e-9


def test_empty_table(spark):
    assert L.score_documents(spark.createDataFrame([], DOCS)).count() == 0
