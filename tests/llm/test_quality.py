from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from waymark.llm import quality
from waymark.llm.tokens import groups

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_columns_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    edge = spark.createDataFrame(
        [
            (-1, None, None, None, None),
            (-2, "", "en", "s", 0),
            (-3, "a b a b a b a b a b a b\n\n \x0b\na\na", "en", "s", 1),
            (-3, "a b a b a b a b a b a b\n\n \x0b\na\na", "en", "s", 1),
            (None, " x   y\u0085z \U0001f600 é", "en", "s", 1),
            (-4, "long " * 700_000 + "end", "en", "s", 1),
        ],
        DOCS,
    )
    docs = docs.unionByName(edge)
    got = sorted((str(tuple(r)) for r in quality.judge(docs).select("doc_id", *COLUMNS).collect()))
    want = sorted(str((r.doc_id, *base(r.text))) for r in docs.collect())
    assert got == want


def plain_figures(text, bpe, pieces):
    """Script, tokens, characters per token, byte share, entropy and verdict of one text, one word at a time."""
    found = WORD.findall(text or "")
    tokens = [t for w in found for t in bpe.encode_ordinary(" " + w)]
    own = [t for w in found for t in pieces.encode(w)]
    counts = Counter(tokens)
    n = len(tokens)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    letters = Counter()
    for c in text or "":
        if c.isascii():
            letters["latin"] += c.isalpha()
        else:
            letters.update([name for name, *ranges in quality.RANGES for a, b in ranges if a <= ord(c) <= b][:1])
    accented = letters.pop("latin_accented", 0)
    letters["latin"] += accented
    script = max(quality.SCRIPTS[1:], key=lambda x: letters[x]) if sum(letters.values()) else "none"
    if script == "latin" and accented >= quality.ACCENTED_SHARE * letters["latin"] and accented:
        script = "latin_accented"
    per = sum(map(len, found)) / max(n, 1)
    share = sum(pieces.is_byte(t) for t in own) / max(len(own), 1)
    band, root = quality.BANDS[script], math.sqrt(max(n, 1))
    good = (
        band.chars_per_token[0] - quality.SLACK["chars_low"] / root <= per <= band.chars_per_token[1] + quality.SLACK["chars_high"] / root
        and share <= band.byte_share + quality.SLACK["byte_share"] / root
        and entropy >= (band.entropy_share - quality.SLACK["entropy_share"] / root) * min(math.log2(max(n, 2)), band.full_entropy)
    )
    return script, n, round(per, 6), round(share, 6), round(entropy, 6), good and not base(text)[-1]


def test_figures_and_verdict_match_brute_force(spark, sf):
    fertility = quality.Fertility(quality.VOCABULARIES)
    edge = [(-1 - i, t, None, None, None) for i, t in enumerate([None, "", *JUNK.values(), *GOOD.values(), "é", "42", "日本 語 and", "ქართული ენა"])]
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(spark.createDataFrame(edge, DOCS))
    figures = ["script", "n_tokens", "chars_per_token", "byte_share", "token_entropy", "kept"]
    got = {r.doc_id: tuple(round(x, 6) if isinstance(x, float) else x for x in r[1:]) for r in quality.judge(docs).select("doc_id", *figures).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == plain_figures(r.text, fertility.bytes_bpe, fertility.pieces), (r.doc_id, r.text)


rng = random.Random(1)
#: Base rules pass all of these.
JUNK = {
    "digests": " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(60)),
    "base64": " ".join(base64.b64encode(rng.randbytes(45)).decode() for _ in range(60)),
    "letters": " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 10))) for _ in range(80)),
    "wrong character set": " ".join(
        "".join(rng.choices("éèàçüößñ", k=3)).encode().decode("latin-1") + rng.choice("abcdefgh") for _ in range(80)
    ),
    "two words": " ".join(rng.choices(["na", "la"], k=400)),
}
GOOD = {
    "english": "The committee will meet on Thursday to discuss the new proposals for the city budget, which were published last week and have drawn criticism.",
    "german": "Der Ausschuss tritt am Donnerstag zusammen, um die neuen Vorschläge für den Haushalt der Stadt zu besprechen, die letzte Woche erschienen.",
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "georgian": "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით მათ მინიჭებული აქვთ გონება",
    "amharic": "የሰው ልጅ ሁሉ ሲወለድ ነጻና በክብርና በመብትም እኩልነት ያለው ነው የተፈጥሮ ማስተዋልና ሕሊና ስላለው",
    "hindi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है",
}


def test_bands_reject_junk_and_keep_prose(spark):
    rows = [(k, t) for k, t in {**JUNK, **GOOD}.items()]
    judged = {r.doc_id: (r.base_failed, r.kept) for r in spark.createDataFrame(rows, "doc_id string, text string").transform(
        lambda d: quality.judge(d.withColumn("doc_id", F.xxhash64("doc_id")))).collect()}
    names = spark.createDataFrame(rows, "name string, text string").select("name", F.xxhash64("name").alias("h")).collect()
    told = {r.name: judged[r.h] for r in names}
    assert not any(told[k][1] for k in JUNK), told
    assert all(told[k][1] for k in GOOD), told
    assert sum(not told[k][0] for k in JUNK) >= 4, told  # the bands decide, not the base rules


def test_a_text_of_20_mb():
    import tracemalloc

    part = "the quick brown fox and über 漢字 some words\n" * 50
    _, _, texts = next(groups(pa.array([part * (20_000_000 // len(part.encode()))])))
    fertility = quality.Fertility(quality.VOCABULARIES)
    tracemalloc.start()
    found = quality.measure_texts(texts, fertility, quality.BANDS)
    assert tracemalloc.get_traced_memory()[1] < 900_000_000
    tracemalloc.stop()
    assert found["n_words"][0] == 9 * 50 * (20_000_000 // len(part.encode())) and found["script"][0] == "latin_accented"


def test_documents_of_good_quality_stay(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    assert judged.where(~F.col("base_failed") & ~F.col("kept")).count() == 0


def test_bytes_that_no_vocabulary_knows_are_rejected(spark):
    odd = " ".join("".join(chr(0x13000 + 17 * (i * 7 + j) % 800) for j in range(6)) for i in range(40))
    plain = "the quick brown fox jumps over the lazy dog while some other animals watch from a hill nearby " * 1
    rows = spark.createDataFrame([(1, odd), (2, plain)], "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in quality.judge(rows).collect()}
    assert kept == {1: False, 2: True}


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], DOCS)).count() == 0
