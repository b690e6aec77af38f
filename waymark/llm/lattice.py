"""LM scoring by subword lattices over an existing vocabulary.

A word (after a blank that opens it) can be cut into vocabulary pieces in many ways, or
spelled in bytes. With a probability per piece, the forward recursion in log space sums
all of them, and a document's probability is the product over its words and one end.
The public vocabulary is ranked, not weighted: its scores order the pieces, a Zipf law
over that order is the prior, and expectation-maximisation over the training words'
counts, on the executors, turns it into piece probabilities. The pieces themselves are
never trained.

Beside it stands the base score, add-one unigrams of the training tokens. Each distinct word is scored
once, and counts and scores move by 64-bit word hashes. Words that hold at least a FREQUENT share of all tokens (at
most 1 / FREQUENT words) go to every task; the others are joined by hash.

Defined results:
- null and empty texts are the end token alone; every row has one;
- words of any length are scored whole, long ones part by part;
- rows with a null doc_id aren't learned from and count as held out;
- repeated rows get equal scores, each row its own; without training rows N = V = 0 and
  the lattice keeps its prior;
- an empty table gives no rows; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import exp, inf, log1p

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .tokens import BASE, LOWER, U64, Texts, finalize, groups, words_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 2
#: Weight of the prior, in pieces.
PRIOR = 10_000.0
FREQUENT = 1e-6
#: Words longer than that stay out of the broadcast table, to bound its bytes while it is made.
FREQUENT_CHARS = 64
LONG = 64
#: Longer words are scored one by one, in parts of so many bytes: memory is 16 bytes a byte of the word.
ALONE = 1 << 12
PART = 1 << 15
COUNTED_BYTES = 1 << 21
MASK = (1 << 64) - 1
BLOCK_BYTES = 400_000


class Pieces:
    """The vocabulary as hashes of byte strings, a blank standing for the word mark."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark, texts, order = "▁", {}, []
        self.byte_id = np.full(256, -1, np.int64)
        self.n = model.get_piece_size()
        for i in range(self.n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or mark in piece[1:]):
                texts[i] = piece.replace(mark, " ").encode()
            order.append((-model.get_score(i), i))
        rank = np.empty(self.n)
        rank[[i for _, i in sorted(order)]] = np.arange(self.n)
        usable = np.zeros(self.n, bool)
        usable[list(texts)] = True
        rank[self.byte_id[self.byte_id >= 0]] = 50.0 * self.n  # bytes are the last resort
        usable[self.byte_id[self.byte_id >= 0]] = True
        self.prior = np.where(usable, 1.0 / (rank + 10.0), 0.0)
        self.prior /= self.prior.sum()
        self.longest = max(map(len, texts.values()))
        piece_of: dict[tuple[int, int], int] = {}
        for i, text in texts.items():
            h = 0
            for size, b in enumerate(text, 1):
                h = (h * BASE + b + 1) & MASK
                piece_of.setdefault((h, size), -1)
            piece_of[h, len(text)] = i
        raw = np.array([h for h, _ in piece_of], U64) + np.array([size for _, size in piece_of], U64)
        keys = finalize(raw)
        by = np.argsort(keys)
        #: Hashes of all pieces and of their openings, which have id -1.
        self.keys, self.ids = keys[by], np.array(list(piece_of.values()))[by]
        self.present = np.zeros(1 << 20, bool)
        self.present[(self.keys >> U64(44)).astype(np.int64)] = True

    @staticmethod
    def key(text: bytes) -> int:
        h = 0
        for b in text:
            h = (h * BASE + b + 1) & MASK
        return int(finalize(np.array([h], U64) + U64(len(text)))[0])

    def arcs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte, byte after, piece) of every piece that matches inside a word data[start:end], and of every byte."""
        stop = np.repeat(end, end - start)
        place = np.arange(len(data))
        h = np.zeros(len(data), U64)
        value = data.astype(U64) + U64(1)
        begins, ends, pieces = [place], [place + 1], [self.byte_id[data]]
        live = place
        for size in range(1, self.longest + 1):
            live = live[live + size <= stop[live]]
            if not len(live):
                break
            h[live] = h[live] * U64(BASE) + value[live + size - 1]
            key = finalize(h[live] + U64(size))
            maybe = np.flatnonzero(self.present[(key >> U64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == key[maybe]
            live = live[maybe[hit]]
            found = self.ids[at[hit]]
            whole = found >= 0
            begins.append(live[whole])
            ends.append(live[whole] + size)
            pieces.append(found[whole])
        begin, finish, piece = np.concatenate(begins), np.concatenate(ends), np.concatenate(pieces)
        good = piece >= 0
        return begin[good], finish[good], piece[good]


@lru_cache(maxsize=1)
def pieces_at(path: str) -> Pieces:
    """Read once in each process."""
    return Pieces(path)


def levels(key: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of equal keys: indices of each, in rising order of key."""
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    return iter(np.split(order, cuts)) if len(order) else iter(())


def arcs_in(
    pieces: Pieces, logp: np.ndarray, data: np.ndarray, at: int, to: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after, piece, weight) of the arcs of one word that begin in at:to, by first byte; places from ``at`` on."""
    piece_of = data[at : min(to + pieces.longest, len(data))]
    begin, finish, piece = pieces.arcs(piece_of, np.zeros(1, np.int64), np.array([len(piece_of)]))
    mine = np.flatnonzero(begin < to - at)
    mine = mine[np.argsort(begin[mine], kind="stable")]
    return begin[mine], finish[mine], piece[mine], logp[piece[mine]]


def relax(level: list[float], sources: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> None:
    """Add each arc's share, in log space, to its target's level; arcs come in the order of their sources."""
    for source, target, weight in zip(sources.tolist(), targets.tolist(), weights.tolist()):
        new, old = level[source] + weight, level[target]
        high, low = (new, old) if new > old else (old, new)
        if low != -inf:
            high += log1p(exp(low - high))
        level[target] = high


def lattice_of_long(
    pieces: Pieces, logp: np.ndarray, word: bytes, weight: float | None = None
) -> tuple[float, np.ndarray | None]:
    """``lattice`` of one word, part by part."""
    data = np.frombuffer(b" " + word, np.uint8)
    n = len(data)
    forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0.0
    parts = [(at, min(at + PART, n)) for at in range(0, n, PART)]
    for at, to in parts:
        begin, finish, _, share = arcs_in(pieces, logp, data, at, to)
        near = forward[at : to + pieces.longest + 1].tolist()
        relax(near, begin, finish, share)
        forward[at : to + pieces.longest + 1] = near
    if weight is None:
        return float(forward[n]), None
    expected = np.zeros(pieces.n)
    for at, to in reversed(parts):
        begin, finish, piece, share = arcs_in(pieces, logp, data, at, to)
        near = backward[at : to + pieces.longest + 1].tolist()
        relax(near, finish[::-1], begin[::-1], share[::-1])
        backward[at : to + pieces.longest + 1] = near
        passes = np.exp(forward[at + begin] + share + backward[at + finish] - forward[n])
        expected += np.bincount(piece, weights=weight * passes, minlength=pieces.n)
    return float(forward[n]), expected


def lattice(
    pieces: Pieces, logp: np.ndarray, words: list[bytes], weights: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each word over all its cuts; with weights also the expected piece counts."""
    out = np.zeros(len(words))
    expected = np.zeros(pieces.n) if weights is not None else None
    sizes = np.array([len(w) for w in words], np.int64) + 1
    order = np.argsort(sizes, kind="stable")
    short = int(np.searchsorted(sizes[order], ALONE, "right"))
    for i in order[short:].tolist():
        out[i], own = lattice_of_long(pieces, logp, words[i], None if weights is None else float(weights[i]))
        if expected is not None:
            expected += own
    order, at = order[:short], 0
    while at < len(order):
        to = at + max(1, int(np.searchsorted(np.cumsum(sizes[order[at : at + BLOCK_BYTES]]), BLOCK_BYTES, "right")))
        if sizes[order[at]] <= LONG:  # long words go apart: the recursion takes as many steps as the longest
            to = min(to, int(np.searchsorted(sizes[order], LONG, "right")))
        block = order[at:to]
        at = to
        data = np.frombuffer(b"".join(b" " + words[i] for i in block), np.uint8)
        end = np.cumsum(sizes[block])
        start = end - sizes[block]
        begin, finish, piece = pieces.arcs(data, start, end)
        weight = logp[piece]
        node = begin + np.repeat(np.arange(len(block)), sizes[block])[begin]  # one node more than bytes a word
        target = node + finish - begin
        first = start + np.arange(len(block))
        last = end + np.arange(len(block))
        offset = begin - np.repeat(start, sizes[block])[begin]
        as_byte = piece == pieces.byte_id[data[begin]]  # a one-byte piece may stand beside the byte itself
        steps = list(levels((offset * (pieces.longest + 1) + finish - begin) * 2 + as_byte))
        forward = np.full(int(last[-1]) + 1, -np.inf)
        forward[first] = 0.0
        for arc in steps:  # by place, length and kind: no two arcs of a step meet
            forward[target[arc]] = np.logaddexp(forward[target[arc]], forward[node[arc]] + weight[arc])
        out[block] = forward[last]
        if expected is not None:
            backward = np.full(len(forward), -np.inf)
            backward[last] = 0.0
            for arc in reversed(steps):
                backward[node[arc]] = np.logaddexp(backward[node[arc]], backward[target[arc]] + weight[arc])
            of = np.repeat(np.arange(len(block)), sizes[block])[begin]
            share = np.exp(forward[node] + weight + backward[target] - out[block][of])
            expected += np.bincount(piece, weights=share * weights[block][of], minlength=pieces.n)
    return out, expected


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(True))


def lowered(texts: Texts) -> Texts:
    return Texts(LOWER[texts.data], texts.offsets)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, n of them to train on), summed within groups of rows: larger ones, for fewer rows to shuffle."""
    for batch in batches:
        held = batch.column("held_out").to_numpy(zero_copy_only=False)
        for at, to, texts in groups(batch.column("text"), COUNTED_BYTES):
            words, texts = words_of(texts), lowered(texts)
            _, first, back, count = np.unique(words.hash, return_index=True, return_inverse=True, return_counts=True)
            learned = ~held[at:to].astype(bool)[words.text_of()]
            spelled = [texts.data[s:e].tobytes() for s, e in zip(words.start[first].tolist(), words.end[first].tolist())]
            trained = np.bincount(back, weights=learned, minlength=len(first)).astype(np.int64)
            columns = [pa.array(spelled, pa.binary()), pa.array(words.hash[first].view(np.int64)), pa.array(count), pa.array(trained)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "hash", "n", "c"])


def expecter(path: str, logp: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_at(path)
        total = np.zeros(pieces.n)
        for batch in batches:
            total += lattice(pieces, logp, batch.column("word").to_pylist(), batch.column("c").to_numpy().astype(float))[1]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["piece", "expected"])

    return run


def fit_pieces(counts: DataFrame, end_tokens: int, path: str, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """(natural log probability of each piece, of the end). Only sums per piece come to the driver."""
    prior = pieces_at(path).prior
    p = prior
    total = 0.0
    with np.errstate(divide="ignore"):
        for _ in range(rounds):
            sums = (
                counts.where("c > 0")
                .select("word", "c")
                .mapInArrow(expecter(path, np.log(p)), "piece bigint, expected double")
                .groupBy("piece")
                .agg(F.sum("expected").alias("expected"))
                .toArrow()
            )
            expected = np.zeros(len(prior))
            expected[sums["piece"].to_numpy()] = sums["expected"].to_numpy()
            total = expected.sum()
            p = (expected + PRIOR * prior) / (total + PRIOR)
        end = (end_tokens + 1) / (end_tokens + 1 + total + PRIOR)
        return np.log(p * (1 - end)), float(np.log(end))


def word_scorer(path: str, logp: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_at(path)
        for batch in batches:
            scores = lattice(pieces, logp, batch.column("word").to_pylist())[0]
            columns = [batch.column("hash"), batch.column("c"), batch.column("frequent"), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "c", "frequent", "score"])

    return run


ROWS = (
    "row_key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double,"
    " log_score double, rare array<bigint>, rare_n array<int>"
)


def row_scorer(
    end_logp: float, end_tokens: int, hot: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the sums over their frequent words and the end, and the hashes of their rare words."""
    last = np.array([0], U64)  # stands where there is no frequent word
    hot_hash, hot_c, hot_score = hot if len(hot[0]) else (last, np.zeros(1, np.int64), np.zeros(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, to, texts in groups(batch.column("text")):
                words, n = words_of(texts), to - at
                distinct, back = np.unique(words.hash, return_inverse=True)
                place = np.minimum(np.searchsorted(hot_hash, distinct), len(hot_hash) - 1)
                frequent = hot_hash[place] == distinct
                count = np.where(frequent, hot_c[place], 0)
                score = np.where(frequent, hot_score[place], 0.0)
                of = words.text_of()
                total = lambda per_word: np.bincount(of, weights=per_word[back], minlength=n)
                rare = ~frequent[back]
                wide = len(distinct) + 1
                pair, many = np.unique(of[rare] * wide + back[rare], return_counts=True)
                cuts = np.searchsorted(pair, np.arange(n + 1) * wide).astype(np.int32)
                hashes = distinct[pair % wide].view(np.int64) if len(pair) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key + np.arange(n)),
                        batch.column("doc_id")[at:to].cast(pa.int64()),
                        batch.column("held_out")[at:to],
                        pa.array(words.counts + 1),
                        pa.array(total((count > 0).astype(float)).astype(np.int64) + (end_tokens > 0)),
                        pa.array(total(np.log10(count + 1)) + np.log10(end_tokens + 1)),
                        pa.array(total(score) + end_logp),
                        pa.ListArray.from_arrays(cuts, pa.array(hashes)),
                        pa.ListArray.from_arrays(cuts, pa.array(many.astype(np.int32))),
                    ],
                    [f.split()[0] for f in ROWS.split(", ")],
                )
                key += n

    return run


def score_documents(docs: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text"))
    counts = cut(
        rows.select("text", "held_out")
        .mapInArrow(count_words, "word binary, hash bigint, n bigint, c bigint")
        .groupBy("word", "hash")
        .agg(F.sum("n").alias("n"), F.sum("c").alias("c")),
        "words",
    )
    tokens, trained, distinct = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)
    ).first()
    ends = rows.where(~F.col("held_out")).count()
    trained, distinct = trained + ends, distinct + (ends > 0)
    logp, end_logp = fit_pieces(counts, ends, path, rounds)
    frequent = (F.col("n") >= max(2, FREQUENT * tokens)) & (F.octet_length("word") <= FREQUENT_CHARS)
    words = cut(
        counts.select("word", "hash", "c", frequent.alias("frequent")).mapInArrow(
            word_scorer(path, logp), "hash bigint, c bigint, frequent boolean, score double"
        ),
        "scores",
    )
    hot = words.where("frequent").toArrow()
    hashes = hot["hash"].to_numpy().view(U64)
    by = np.argsort(hashes)
    shipped = (hashes[by], hot["c"].to_numpy()[by], hot["score"].to_numpy()[by])
    scored = cut(rows.mapInArrow(row_scorer(end_logp, ends, shipped), ROWS), "rows")
    rare = scored.select("row_key", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select(
        "row_key", F.col("w.rare").alias("hash"), F.col("w.rare_n").alias("times")
    )
    sums = (
        rare.join(words.where("NOT frequent").select("hash", "c", "score"), "hash")
        .groupBy("row_key")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("c").cast("double") + 1)).alias("more_log"),
            F.sum(F.col("times") * F.col("score")).alias("more_score"),
        )
    )
    rows_total = float(np.log10(trained + distinct + 1))
    return scored.join(sums, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(trained).cast("long").alias("train_tokens"),
        (
            F.col("log_counts") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(rows_total)
        ).alias("base_score"),
        ((F.col("log_score") + F.coalesce("more_score", F.lit(0.0))) / F.lit(float(np.log(10)))).alias("score"),
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
