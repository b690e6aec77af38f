"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the runs of 2, 3 and 4 bytes of its letters (A-Z lower-cased,
ASCII characters that aren't letters, and blocks of punctuation, symbols, digits and emoji, made blank), hashed to buckets.
A document is the mean of its buckets' embeddings; a linear softmax tells the learned languages and one class more,
"another". Embeddings and softmax are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows: whole texts, excerpts of them, and for the class "another" excerpts in disguise, with letters
exchanged within the script or for those of another one, shuffled, or drawn at random.

Rejection is calibrated on rows of the sample that training did not see: the temperature by their log loss, and for each
band of lengths the least probability that may be told, where rejecting rightly told rows and accepting disguises cost
least; a rejected right row counts for REJECTION_COST accepted disguises, in shares of either. No threshold is under
the probability that each of the classes has by chance.

Defined results:
- null text, or a text without a letter: language "und", score 0, rejected;
- the score is the probability of the best learned language; what is rejected keeps its name and score;
- no labelled row at all: "und" with score 0 for every row, rejected; one language: that one, or rejected;
- lang, source and doc_id are never inputs of a prediction; repeated rows get equal results;
- rows with null lang, null text or null doc_id aren't learned from, and are still predicted;
- texts of any length are read whole, in pieces of PIECE_BYTES;
- an empty table gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table
from .tokens import LOWER, PIECE_BYTES, Texts, among, character_cuts, code_points, groups

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
#: The bound of the training sample: rows per language, rows of all languages, characters per row. With more
#: languages each has fewer rows, but no less than LEAST_ROWS, so that none is lost by the draw.
ROWS_PER_LANGUAGE = 1_000
ROWS = 50_000
LEAST_ROWS = 20
MAX_CHARS = 4_000
#: The bound of the sample's characters: with more rows each has a shorter excerpt, but no less than EXCERPT_CHARS.
CHARS = 16_000_000
#: Excerpts and disguises have from so many to so many characters.
EXCERPT_CHARS = (20, 400)
#: One sampled row in so many calibrates and isn't trained on.
CALIBRATION_PART = 5
#: What it costs to reject a right row, in accepted disguises.
REJECTION_COST = 20.0
#: Bands of lengths, in subwords: each has a threshold of its own.
BANDS = (150, 600)
THRESHOLD = 0.5  # of a band without calibration rows

BLANK = 32
LETTERS = np.full(256, BLANK, np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = LOWER[65:91]
LETTERS[128:] = np.arange(128, 256)
#: Code points (first, last) beyond ASCII that are made blank.
NO_LETTERS = np.array(
    [(0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x660, 0x669), (0x6F0, 0x6F9)]
    + [(0x966, 0x96F), (0x2000, 0x20FF), (0x2190, 0x2BFF), (0x2E00, 0x2E7F), (0x3000, 0x3004), (0x3008, 0x3020)]
    + [(0xE000, 0xF8FF), (0xFE10, 0xFE1F), (0xFE30, 0xFE6F), (0xFF00, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]
    + [(0xFFF0, 0xFFFF), (0x1F000, 0x1FAFF)]
)
MULTIPLIERS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}

VOWELS = "aeiouyáéíóúäöüåæøőűıęąôêâõàèìòù"
CONSONANTS = "bcdfghjklmnpqrstvwxzčšžłńśćźğşđřťñçß"
#: Letters (first, number) of other scripts.
BLOCKS = [(0x430, 32), (0x3B1, 24), (0x627, 36), (0x5D0, 27), (0x905, 50), (0xE01, 46), (0xAC00, 400), (0x4E00, 800)]
BLOCKS += [(0x3041, 83), (0x10D0, 33), (0x561, 38), (0x1200, 200), (0x985, 40), (0xB85, 40)]


def letters_of(data: np.ndarray) -> np.ndarray:
    """The bytes of letters, everything else made blank."""
    out = LETTERS[data]
    lead, point, width = code_points(data)
    blank = among(point, NO_LETTERS)
    for j in range(4):
        out[lead[blank & (width > j)] + j] = BLANK
    return out


def buckets_of(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every subword, in pieces; a subword lies in one word, with at most a blank at either end."""
    data = np.empty_like(texts.data)
    for at, to in character_cuts(texts.data, PIECE_BYTES):
        data[at:to] = letters_of(texts.data[at:to])
    more = max(GRAMS) - 1
    for at in range(0, len(data), PIECE_BYTES):  # a piece has the subwords that begin in it
        piece = data[at : at + PIECE_BYTES + more]
        begins = min(PIECE_BYTES, len(data) - at)
        lengths = np.diff(np.clip(texts.offsets - at, 0, len(piece)))
        of = np.repeat(np.arange(texts.n, dtype=np.int32), lengths)
        blank = piece == BLANK
        wide = piece.astype(np.uint32)
        for size in GRAMS:
            m = min(len(piece) - size + 1, begins)
            if m <= 0:
                continue
            code = np.zeros(m, np.uint32)
            for j in range(size):
                code = (code << np.uint32(8)) | wide[j : m + j]
            good = of[:m] == of[size - 1 : size - 1 + m]
            for j in range(1, size - 1):
                good &= ~blank[j : m + j]
            good &= ~(blank[:m] & blank[size - 1 : size - 1 + m])
            code = code * np.uint32(MULTIPLIERS[size])
            yield (code[good] >> np.uint32(32 - 15)).astype(np.int64), of[:m][good]


@dataclass
class Model:
    languages: list[str]
    #: Per bucket the scores of the languages and, last, of "another": embeddings times softmax weights.
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    #: Per band of lengths.
    thresholds: np.ndarray

    def probabilities(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of the learned languages, least probability to be told) of each text."""
        counts = np.zeros(texts.n, np.int64)
        sums = np.zeros((texts.n, len(self.bias)))
        for bucket, of in buckets_of(texts):
            counts += np.bincount(of, minlength=texts.n)
            for k in range(len(self.bias)):
                sums[:, k] += np.bincount(of, weights=self.scores[bucket, k], minlength=texts.n)
        p = softmax((sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)
        return p[:, :-1], self.thresholds[np.digitize(counts, BANDS)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(
    rows: list[tuple[str | None, np.ndarray, np.ndarray]], dim: int = 12, epochs: int = 4, seed: int = 5
) -> Model | None:
    """Train on (language, or None for another; distinct buckets; their counts), in a fixed order."""
    languages = sorted({r[0] for r in rows if r[0] is not None})
    if not languages:
        return None
    index = {lang: k for k, lang in enumerate([*languages, None])}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = {int(i) for i in order[: len(rows) // CALIBRATION_PART]}
    train = [int(i) for i in order if int(i) not in held]
    embed = rng.normal(0, 0.3, (BUCKETS, dim)).astype(np.float32)
    weight = np.zeros((dim, len(index)), np.float32)
    bias = np.zeros(len(index), np.float32)
    totals = [counts.sum() for _, _, counts in rows]

    def share_of(i: int) -> tuple[np.ndarray, np.ndarray]:  # made when wanted: all of them would double the sample
        return rows[i][1], (rows[i][2] / totals[i]).astype(np.float32)

    steps, done = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            rate = 0.5 * (1 - done / steps)
            done += 1
            buckets, share = share_of(i)
            mean = share @ embed[buckets]
            error = softmax(mean @ weight + bias)
            error[index[rows[i][0]]] -= 1
            pull = weight @ error
            weight -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            step = 20 * rate / max(1.0, 20 * float(share @ share))  # a text of few subwords would overshoot
            embed[buckets] -= (step * share)[:, None] * pull
    scores = embed @ weight
    keep = sorted(held) or train
    logits = np.array([share @ scores[buckets] + bias for buckets, share in map(share_of, keep)], np.float64)
    truth = np.array([index[rows[i][0]] for i in keep])
    temperature = calibrate(logits, truth)
    p = softmax(logits / temperature)[:, :-1]
    best, right, other = p.max(1), p.argmax(1) == truth, truth == len(languages)
    band = np.digitize([totals[i] for i in keep], BANDS)
    thresholds = np.array([threshold_of(best[right & (band == k)], best[other & (band == k)]) for k in range(len(BANDS) + 1)])
    thresholds = np.maximum(thresholds, 1 / len(index))
    return Model(languages, scores.astype(np.float64), bias.astype(np.float64), temperature, thresholds)


def threshold_of(own: np.ndarray, other: np.ndarray) -> float:
    """The probability that parts rightly told rows from disguises at the least cost, in the widest gap that does."""
    if not len(own) or not len(other):
        return THRESHOLD
    odds = lambda p: np.log(np.clip(p, 1e-9, 1 - 1e-9) / (1 - np.clip(p, 1e-9, 1 - 1e-9)))
    own, other = np.sort(odds(own)), np.sort(odds(other))
    values = np.unique(np.concatenate((own, other)))
    middle, gap = (values[1:] + values[:-1]) / 2, np.diff(values)
    cost = REJECTION_COST * np.searchsorted(own, middle) / len(own) + 1 - np.searchsorted(other, middle) / len(other)
    if not len(cost):
        return THRESHOLD
    flat = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float(1 / (1 + np.exp(-middle[flat[gap[flat].argmax()]])))


def calibrate(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss."""

    def loss(t: float) -> float:
        return -float(np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())

    return min((float(t) for t in np.geomspace(0.01, 20, 80)), key=loss)


def excerpt(rng: np.random.Generator, text: str) -> str:
    """A part of a text from a drawn place, of a drawn length."""
    low, high = EXCERPT_CHARS
    size = int(np.exp(rng.uniform(np.log(low), np.log(high))))
    at = int(rng.integers(0, max(len(text) - size, 0) + 1))
    return text[at : at + size]


def disguise(rng: np.random.Generator, text: str) -> str:
    """A text of no learned language, with the lengths of words and the rhythm of this one."""
    way = rng.random()
    letters = sorted(set(filter(str.isalpha, text.lower())))

    def drawn(pool: str) -> str:
        return pool[int(rng.integers(len(pool)))]

    if way < 0.6:  # letters exchanged within the script, vowels for vowels
        own = {v: "".join(rng.permutation(list(pool))) for v, pool in ((True, VOWELS), (False, CONSONANTS))}
        plain = 6 if rng.random() < 0.5 else len(VOWELS)
        own = {v: pool[:plain] if v else pool for v, pool in own.items()}
        return text.lower().translate({ord(c): drawn(own[c in VOWELS]) for c in letters})
    if way < 0.8:  # letters of another script
        first, number = BLOCKS[int(rng.integers(len(BLOCKS)))]
        return "".join(chr(first + int(rng.integers(number))) if c.isalpha() and rng.random() < 0.5 else c if not c.isalpha()
                       else chr(first + hash_of(c) % number) for c in text)
    if way < 0.9:  # the letters of each word shuffled
        return " ".join("".join(rng.permutation(list(w))) for w in text.split())
    pool = ("0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz")[int(rng.integers(3))]
    return "".join(drawn(pool) if c.isalpha() else c for c in text)


def hash_of(c: str) -> int:
    return ord(c) * 0x9E3779B1 >> 7


def learnable() -> Column:
    return (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2) & F.col("doc_id").isNotNull()


def sampled(docs: DataFrame, seed: int = 11) -> DataFrame:
    """Labelled rows by a hash draw, about as many of each language; of a long text an excerpt from a drawn place."""
    rows = docs.where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return rows.select("lang", "text").limit(0)
    most = max(LEAST_ROWS, min(ROWS_PER_LANGUAGE, ROWS // len(counts)))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    rate = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, most / r["count"]))])
    expected = sum(min(most, r["count"]) for r in counts)
    chars = max(EXCERPT_CHARS[1], min(MAX_CHARS, CHARS // expected))
    spare = F.greatest(F.length("text") - chars, F.lit(0))
    begin = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "lang"), spare + 1) + 1).cast("int")
    return (
        rows.where(draw < F.try_element_at(rate, F.col("lang")))
        .select("lang", F.substr("text", begin, F.lit(chars)).alias("text"), "doc_id")
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "text", "lang")
        .limit(2 * most * len(counts))
    )


def count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row its text, an excerpt, and a disguise (lang null), as distinct buckets and their counts."""
    for batch in batches:
        langs, whole = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        names, said = [], []
        for lang, text in zip(langs, whole):
            rng = np.random.default_rng(zlib.crc32(text.encode()))
            names += [lang, lang, None]
            said += [text, excerpt(rng, text), disguise(rng, excerpt(rng, text))]
        names = pa.array(names, pa.string())
        for at, to, texts in groups(pa.array(said, pa.string())):
            parts = [of.astype(np.int64) * BUCKETS + bucket for bucket, of in buckets_of(texts)]
            key, count = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
            cuts = np.searchsorted(key, np.arange(texts.n + 1) * BUCKETS).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(cuts, pa.array(x)) for x in ((key % BUCKETS).astype(np.int16), count.astype(np.int32))
            ]
            yield pa.RecordBatch.from_arrays([names[at:to], *lists], ["lang", "buckets", "counts"])


def train(docs: DataFrame) -> Model | None:
    """The sampled rows come to the driver as bucket counts: a few numbers per character of the sample at most, most often far fewer."""
    rows = (
        sampled(docs)
        .select("lang", "text")
        .mapInArrow(count_buckets, "lang string, buckets array<smallint>, counts array<int>")
        .toArrow()
    )
    out = []
    for batch in rows.to_batches():  # slices of the batches, no copies
        langs = batch.column("lang").to_pylist()
        (cuts, buckets), (_, counts) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns[1:])
        out += [(lang, buckets[a:b], counts[a:b]) for lang, a, b in zip(langs, cuts[:-1], cuts[1:]) if b > a]
    return fit(out)


SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"


def predictor(model: Model | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in groups(batch.column("text")):
                has = batch.column("has_letter")[at:to].to_numpy(zero_copy_only=False).astype(bool)
                best, names = np.zeros(texts.n), np.full(texts.n, "und", object)
                least = np.ones(texts.n)
                if model is not None:
                    p, least = model.probabilities(texts)
                    best = np.where(has, p.max(1), 0.0)
                    names = np.where(has, np.array(model.languages, object)[p.argmax(1)], "und")
                bad = ~has | (best < least)
                columns = [batch.column("doc_id")[at:to].cast(pa.int64()), batch.column("held_out")[at:to]]
                columns += [pa.array(names, pa.string()), pa.array(best), pa.array(bad)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row; one pass, no shuffle."""
    rows = docs.select(
        "doc_id",
        F.coalesce(~learnable(), F.lit(True)).alias("held_out"),
        F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)).alias("has_letter"),
        "text",
    )
    return rows.mapInArrow(predictor(model), SCHEMA)


def keeper(model: Model | None, letter: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            names = np.full(batch.num_rows, None, object)
            has = batch.column(letter).to_numpy(zero_copy_only=False).astype(bool)
            for at, to, texts in groups(batch.column("text")) if model is not None else ():
                p, least = model.probabilities(texts)
                good[at:to] = has[at:to] & (p.max(1) >= least)
                names[at:to] = np.array(model.languages, object)[p.argmax(1)]
            columns = [
                pa.array(names, pa.string()) if name == "lang" else batch.column(name)
                for name in batch.schema.names
                if name != letter
            ]
            kept = pa.RecordBatch.from_arrays(columns, [n for n in batch.schema.names if n != letter])
            yield kept.filter(pa.array(good))

    return run


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language isn't rejected; lang becomes the prediction."""
    letter = free_name(docs, "has_letter")
    marked = docs.withColumn(letter, F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)))
    return marked.mapInArrow(keeper(model, letter), docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
