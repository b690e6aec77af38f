"""Quality rules: base rules on words and lines, and tokeniser fertility with bands per script.

A public byte-level vocabulary gives characters per token and the entropy of a document's
tokens, a public piece vocabulary gives the share of tokens that fall back to bytes. Each
distinct word of a batch is tokenised once (as it stands after one blank), and per-document
figures are sums over words. A document is kept if it passes the base rules and its figures lie inside
the band of its main script. A figure of few tokens says less, so a band is wider by SLACK over the root
of their number; no document passes unmeasured.

Defined results:
- null text has no words: base_failed, not kept, figures 0;
- a text's script is the one of most of its letters, the first in SCRIPTS where two have as many; Latin letters
  count as "latin_accented" where one in a hundred or more isn't ASCII; a text without letters has script "none";
- texts of any length are measured whole;
- repeated rows get equal results; a null doc_id keeps its row; an empty table gives no rows;
- further input columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .tokens import IS_BLANK, PIECE_BYTES, SAME, U64, Texts, Words, character_cuts, code_points, finalize, groups, shingles_of, words_of

#: Where the vocabularies lie. They are read on the executors and never copied.
VOCABULARIES = "/opt/tokenizers"
SYMBOLS = b"#*$%&|<>"
#: Words whose tokens a worker remembers; it forgets them all beyond that.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Band:
    """Accepted figures of documents with many tokens."""

    #: Least and most characters of words per token.
    chars_per_token: tuple[float, float]
    #: Most tokens, as a share, that fall back to bytes.
    byte_share: float
    #: Least entropy in bits, as a share of log2(number of tokens) or of full_entropy if that is less.
    entropy_share: float
    full_entropy: float = 8.0


#: How much wider each bound is at one token; at n tokens it is so much over the root of n.
SLACK = {"chars_low": 1.0, "chars_high": 6.0, "byte_share": 0.5, "entropy_share": 0.7}

#: By script. Alphabets that the vocabulary was not made for take more tokens a character. Prose in plain Latin letters has
#: 1.9 to 4.8 characters a token, in accented ones 1.6 to 3; digests 1.6, base64 1.3, random letters 1.5, and text
#: decoded in a wrong character set about 1.
BANDS = {
    "latin": Band((1.75, 7.0), 0.1, 0.65),
    "latin_accented": Band((1.5, 7.0), 0.1, 0.65),
    "greek_cyrillic": Band((0.5, 6.0), 0.25, 0.4),
    "caucasian": Band((0.2, 3.0), 0.9, 0.3),
    "semitic": Band((0.35, 6.0), 0.6, 0.35),
    "indic": Band((0.2, 3.0), 0.9, 0.25),
    "southeast_asian": Band((0.2, 3.0), 0.9, 0.25),
    "east_asian": Band((0.2, 3.0), 0.7, 0.35),
    "none": Band((0.9, 4.0), 0.25, 0.4),
    "other": Band((0.1, 3.0), 0.85, 0.25),  # a word's mark is no byte: words of two letters that no vocabulary knows have 0.86 to 0.89
}
SCRIPTS = ("none", *[name for name in BANDS if name != "none"])
ACCENTED_SHARE = 0.01
#: Code points (first, last) of letters beyond ASCII, by script; what is in none of them, from 0x250 on, and isn't a symbol is "other".
RANGES = [
    ("latin_accented", (0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)),
    ("greek_cyrillic", (0x370, 0x52F), (0x1C80, 0x1C8F), (0x1F00, 0x1FFF)),
    ("caucasian", (0x530, 0x58F), (0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    ("semitic", (0x590, 0x65F), (0x66A, 0x6EF), (0x6FA, 0x8FF), (0xFB1D, 0xFDFF), (0xFE70, 0xFEFE)),
    ("indic", (0x900, 0x965), (0x970, 0xDFF)),
    ("southeast_asian", (0xE00, 0x109F), (0x1780, 0x17FF)),
    ("east_asian", (0x1100, 0x11FF), (0x3005, 0x3007), (0x3021, 0x9FFF), (0xAC00, 0xD7AF), (0xF900, 0xFAFF), (0xFF66, 0xFFDC), (0x20000, 0x3FFFF)),
    ("other", (0x250, 0x2AF), (0x1200, 0x177F), (0x1800, 0x1C7F), (0x2C00, 0x2DFF), (0xA000, 0xABFF), (0x10000, 0x1CFFF), (0x1E000, 0x1EFFF)),
]
LETTER_RANGES = np.array(sorted((a, b, SCRIPTS.index(name)) for name, *ranges in RANGES for a, b in ranges))


def script_counts(data: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Per text the letters of each script; ``of`` is the text of each byte."""
    ascii_letters = (data | 32) - 97 < 26
    counts = np.zeros((n, len(SCRIPTS)), np.int64)
    counts[:, SCRIPTS.index("latin")] = np.bincount(of[ascii_letters], minlength=n)
    lead, point, _ = code_points(data)
    at = np.searchsorted(LETTER_RANGES[:, 0], point, "right") - 1
    inside = (at >= 0) & (point <= LETTER_RANGES[np.maximum(at, 0), 1])
    key = of[lead[inside]] * len(SCRIPTS) + LETTER_RANGES[at[inside], 2]
    return counts + np.bincount(key, minlength=n * len(SCRIPTS)).reshape(n, -1)


def scripts_of(counts: np.ndarray) -> np.ndarray:
    """The place in SCRIPTS of each text's script."""
    plain, accented = SCRIPTS.index("latin"), SCRIPTS.index("latin_accented")
    letters = counts.copy()
    letters[:, plain] += letters[:, accented]
    letters[:, accented] = 0
    script = np.where(letters.sum(1) > 0, letters.argmax(1), 0)
    marked = counts[:, accented] >= ACCENTED_SHARE * np.maximum(letters[:, plain], 1)
    return np.where((script == plain) & marked, accented, script)


FIELDS = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("script", pa.string()),
    ("n_tokens", pa.int64()),
    ("chars_per_token", pa.float64()),
    ("byte_share", pa.float64()),
    ("token_entropy", pa.float64()),
]
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, script string, n_tokens bigint, chars_per_token double, byte_share double,"
    " token_entropy double"
)


class Fertility:
    """Tokens of words under the two vocabularies, remembered by word hash."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        import public_tokenizers

        with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_bpe = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.opens = np.zeros(1 + max(ranks.values()), bool)
        self.opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        self.forget()

    def forget(self) -> None:
        self.row: dict[int, int] = {}
        self.tokens = np.zeros(0, np.uint32)  # of all remembered words, end to end
        self.ends = np.zeros(1, np.int64)
        self.piece_counts = np.zeros((0, 2), np.int64)  # pieces, of which bytes

    def learn(self, hashes: list[int], words: list[str]) -> None:
        ids = np.array(self.bytes_bpe.encode_ordinary(" " + " ".join(words)), np.uint32)
        first = np.flatnonzero(self.opens[ids])
        if len(first) != len(words):  # a word holds a token that opens with a blank: one by one
            each = [self.bytes_bpe.encode_ordinary(" " + w) for w in words]
            ids = np.array([t for own in each for t in own], np.uint32)
            first = np.concatenate(([0], np.cumsum([len(own) for own in each])[:-1])).astype(np.int64)
        own = self.pieces.encode(words, num_threads=1)
        counts = np.array([len(p) for p in own], np.int64)
        flat = np.array([t for p in own for t in p], np.int64)
        of = np.repeat(np.arange(len(own)), counts)
        fallen = np.bincount(of, weights=self.is_byte[flat], minlength=len(own)).astype(np.int64)
        at = len(self.ends) - 1
        self.row.update(zip(hashes, range(at, at + len(hashes))))
        base = self.ends[-1]
        self.tokens = np.concatenate((self.tokens, ids))
        self.ends = np.concatenate((self.ends, base + np.append(first[1:], len(ids))))
        self.piece_counts = np.concatenate((self.piece_counts, np.stack((counts, fallen), 1)))

    def rows_of(self, texts: Texts, words: Words) -> np.ndarray:
        """For each word the row of its tokens."""
        distinct, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if len(self.row) > REMEMBERED:
            self.forget()
        new = [k for k, h in enumerate(keys) if h not in self.row]
        if new:
            places = first[new]
            self.learn(
                [keys[k] for k in new],
                [
                    texts.data[s:e].tobytes().decode("utf-8", "replace")
                    for s, e in zip(words.start[places].tolist(), words.end[places].tolist())
                ],
            )
        return np.array([self.row[h] for h in keys], np.int64)[back] if keys else np.zeros(0, np.int64)

    def measure(self, texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: number of tokens, entropy of the tokens in bits, share of byte pieces."""
        n, of = texts.n, words.text_of()
        rows = self.rows_of(texts, words)
        length = (self.ends[1:] - self.ends[:-1])[rows]
        n_tokens = np.bincount(of, weights=length, minlength=n).astype(np.int64)
        pieces = np.bincount(of, weights=self.piece_counts[rows, 0], minlength=n)
        fallen = np.bincount(of, weights=self.piece_counts[rows, 1], minlength=n)
        total = int(length.sum())
        begin = np.repeat(self.ends[rows] - np.concatenate(([0], np.cumsum(length)[:-1])), length) if total else 0
        ids = self.tokens[begin + np.arange(total)] if total else np.zeros(0, np.uint32)
        key = np.sort(np.repeat(of, length).astype(U64) * U64(1 << 17) + ids)
        cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if total else np.zeros(0, np.int64)
        count = np.diff(np.append(cut, total)).astype(float)
        text = (key[cut] >> U64(17)).astype(np.int64)
        share = count / np.maximum(n_tokens[text], 1)
        entropy = np.bincount(text, weights=-share * np.log2(share), minlength=n) if total else np.zeros(n)
        return n_tokens, entropy, fallen / np.maximum(pieces, 1)


def duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(words: Words, n: int, size: int = 5) -> np.ndarray:
    """Per text the words that lie in a window of ``size`` words found twice or more in the text."""
    hashes, first = shingles_of(words, size)
    if not len(first):
        return np.zeros(n, np.int64)
    of = words.text_of()
    own = finalize(hashes + finalize(of[first].astype(U64)))
    _, back, count = np.unique(own, return_inverse=True, return_counts=True)
    begin = first[count[back] >= 2]
    mark = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(mark, begin, 1)
    np.add.at(mark, begin + size, -1)
    return np.bincount(of, weights=np.cumsum(mark[:-1]) > 0, minlength=n).astype(np.int64)


def inside_bands(
    script: np.ndarray, n_tokens: np.ndarray, per_token: np.ndarray, byte_share: np.ndarray, entropy: np.ndarray, bands: dict[str, Band]
) -> np.ndarray:
    """Mask of the documents whose figures lie in the band of their script."""
    band = [bands[s] for s in SCRIPTS]
    of = lambda f: np.array([f(b) for b in band], float)[script]
    slack = {name: most / np.sqrt(np.maximum(n_tokens, 1)) for name, most in SLACK.items()}
    most = np.minimum(np.log2(np.maximum(n_tokens, 2)), of(lambda b: b.full_entropy))
    return (
        (per_token >= of(lambda b: b.chars_per_token[0]) - slack["chars_low"])
        & (per_token <= of(lambda b: b.chars_per_token[1]) + slack["chars_high"])
        & (byte_share <= of(lambda b: b.byte_share) + slack["byte_share"])
        & (entropy >= (of(lambda b: b.entropy_share) - slack["entropy_share"]) * most)
    )


def measure_texts(texts: Texts, fertility: Fertility, bands: dict[str, Band]) -> dict[str, np.ndarray]:
    words = words_of(texts, lower=False)
    n = texts.n
    word_chars, n_symbols, letters = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, len(SCRIPTS)), np.int64)
    symbol = np.isin(SAME, np.frombuffer(SYMBOLS, np.uint8))
    for at, to in character_cuts(texts.data, PIECE_BYTES):
        piece = texts.data[at:to]
        of = np.repeat(np.arange(n), np.diff(np.clip(texts.offsets - at, 0, to - at)))
        word_chars += np.bincount(of[((piece & 0xC0) != 0x80) & ~IS_BLANK[piece]], minlength=n)
        n_symbols += np.bincount(of[symbol[piece]], minlength=n)
        letters += script_counts(piece, of, n)
    n_words, script = words.counts, scripts_of(letters)
    repeats = repeated_words(words, n)
    failed = (n_words < 10) | (100 * repeats > 20 * n_words)
    n_tokens, entropy, byte_share = fertility.measure(texts, words)
    per_token = word_chars / np.maximum(n_tokens, 1)
    good = inside_bands(script, n_tokens, per_token, byte_share, entropy, bands)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": np.array([duplicate_lines(texts.bytes_of(i)) for i in range(n)], np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": ~failed & good,
        "script": np.array(SCRIPTS, object)[script],
        "n_tokens": n_tokens,
        "chars_per_token": per_token,
        "byte_share": byte_share,
        "token_entropy": entropy,
    }


def measurer(folder: str, bands: dict[str, Band]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = Fertility(folder)
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for at, to, texts in groups(batch.column("text")):
                found = measure_texts(texts, fertility, bands)
                columns = [ids[at:to]] + [pa.array(found[name], kind) for name, kind in FIELDS]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id"] + [name for name, _ in FIELDS])

    return run


def judge(docs: DataFrame, bands: dict[str, Band] | None = None, folder: str = VOCABULARIES) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its figures, base_failed and kept; one pass, no shuffle."""
    return docs.select("doc_id", "text").mapInArrow(measurer(folder, bands or BANDS), SCHEMA)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
