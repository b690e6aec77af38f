"""Benchmark decontamination: CGK walks, repeated bit-sampling LSH over item-sized windows, exact edit verification.

Texts are words (A-Z lower-cased, ASCII punctuation read as blanks). In scripts that are written
without blanks (Chinese, Japanese, Thai, Lao, Khmer, Burmese, Tibetan and others) each
character is a word, and their punctuation is blanks too. An item of n words
leaks into a document if some run of the document's words is within k word edits of it,
k = n // 5 (at most n // 3 - 1), or 0 if n is under LEAST_WORDS. The search:

1. Windows: within k edits one of k + 1 segments of an item stands unchanged in the
   document, so windows are laid around every place where the rarest three words of some segment stand. A window
   knows its place and the size (a power of two) of such items, not which item it may hold.
2. CGK embedding: from that place a random walk goes through the window: at each step it emits the word
   where it stands and goes on by one or stays, as a random bit of (repetition, step, word) tells. Two
   texts within few edits fall into step again after each edit, so their walks have a small Hamming distance.
   Every second repetition walks to the left.
3. Bit sampling: SAMPLED emitted words of a repetition are a bucket's key. The steps are drawn log-uniformly up to
   the size, which a walk from the middle of an item takes to its end, since the share of equal steps falls with the length of the walk. Items have been put into these
   buckets from each of their segments; an item is a candidate in a window if any of REPETITIONS buckets holds it.
4. Verification: windows of one item that overlap are taken together; where
   enough of the item's words stand in any order, the exact edit distance between the item and the best run of words is found.

Steps 1 and 4 lose no leak; REPETITIONS is set for a recall of 0.99 in steps 2 and 3 even where a single segment
is unchanged, and items with more edits have more segments.

Items are broadcast in blocks of bounded size, each executor process builds a block's index once, and documents are read
in place: nothing is shuffled, so no passage, however common, makes a hot key.

Defined results:
- null and empty texts hold no leak; repeated rows get repeated results; null doc_id keeps its rows;
- items of fewer than ANCHOR words are too common to be a leak inside a text: they leak into
  documents that are that item as a whole; items without a word match nothing;
- an item with a null item_id is searched and reported with a null item_id, unless an item with an id has the
  same text and stands for it;
- an item that occurs several times in a document is reported once, at its nearest copy; of its nearest runs the one
  that ends first is told, and of these the shortest;
- an empty table of documents or items gives no leak; further columns are kept by
  ``drop_leaks`` and ignored by ``find_leaks``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import U64, Texts, Words, among, code_points, finalize, fold, groups, shingles_of, words_of

#: Shorter items must stand word for word.
LEAST_WORDS = 8
ANCHOR = 3
#: Buckets that an item is put into from each of its segments, and the emitted words that make a bucket's key.
REPETITIONS = 64
SAMPLED = 2
#: Texts are searched in groups of about so many bytes: a walk takes as many numpy calls for few windows as for many.
SEARCHED_BYTES = 1 << 22
#: Windows are worked on together up to so many, and up to so many cells of a table of theirs.
WINDOWS, CELLS = 512, 1 << 20
#: Candidates of a run of windows, and bucket entries that are met at once.
CANDIDATES, MET = 1 << 18, 1 << 20
#: Windows of a text that are looked at before the others where any leak will do.
EARLY = 4
#: Items go to the executors in blocks of about so many bytes of text.
BLOCK_BYTES = 4_000_000

PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32

#: Code points (first, last) of letters of scripts written without blanks, by block, and of their blanks and punctuation.
UNSPACED = np.array(
    [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF)]
    + [(0x3005, 0x3007), (0x3021, 0x302F), (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF)]
    + [(0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]
)
PUNCTUATION = np.array(
    [(0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]
)


def parted(texts: Texts) -> Texts:
    """The texts with blanks around each character of scripts written without blanks."""
    data = PLAIN[texts.data]
    first, point, width = code_points(data)
    if not len(first):
        return Texts(data, texts.offsets)
    blank = among(point, PUNCTUATION)
    for j in range(4):
        data[first[blank & (width > j)] + j] = 32
    alone = among(point, UNSPACED)
    cuts = np.unique(np.concatenate((first[alone], first[alone] + width[alone])))
    cuts = cuts[cuts < len(data)]
    return Texts(np.insert(data, cuts, 32), texts.offsets + np.searchsorted(cuts, texts.offsets))


def plain_words(texts: Texts) -> Words:
    return words_of(parted(texts))


def allowed_edits(n: np.ndarray) -> np.ndarray:
    return np.where(n < LEAST_WORDS, 0, np.minimum(n // 5, n // 3 - 1))


@dataclass
class Index:
    """A block of items, symbols end to end: item k is symbols[bounds[k]:bounds[k + 1]]."""

    ids: np.ndarray
    size: np.ndarray
    edits: np.ndarray
    symbols: np.ndarray
    bounds: np.ndarray
    #: Items as whole documents: hash -> item, for those of fewer than ANCHOR words.
    whole: dict[int, int]
    #: Three-word hashes that lay windows, sorted, and the size class of their items.
    anchor_hash: np.ndarray
    anchor_class: np.ndarray
    #: Buckets, sorted by key: the item, and where in it the walk began.
    bucket_key: np.ndarray
    bucket_item: np.ndarray
    bucket_place: np.ndarray


def size_class(size: np.ndarray) -> np.ndarray:
    """The least power of two that isn't under a size, as its exponent; of longer items the walk goes through 256 words."""
    return np.minimum(np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), 8)


@lru_cache(maxsize=64)
def sampled_steps(kind: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each repetition: direction, sampled steps of the walk in rising order, a multiplier for each step."""
    rng = np.random.default_rng([kind, 77])
    out = []
    for r in range(REPETITIONS):
        length = 1 << kind  # an item's words on one side of a place, half its size, take so many steps
        steps = np.unique(np.exp(rng.uniform(0, np.log(length), SAMPLED)).astype(np.int64))
        while len(steps) < SAMPLED:
            steps = np.unique(np.append(steps, rng.integers(0, max(length, SAMPLED))))
        factors = rng.integers(0, 1 << 63, int(steps[-1]) + 1, dtype=U64) * U64(2) + U64(1)
        out.append((1 if r % 2 == 0 else -1, steps, factors))
    return out


def bucket_keys(
    flat: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, kind: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, good) of each repetition for walks that begin at ``place``; walks that leave low..high at a sample aren't good.

    A walk to the left begins at the anchor's last word, so both directions begin inside the anchor.
    """
    for r, (way, steps, factors) in enumerate(sampled_steps(kind)):
        at = place.copy() if way > 0 else place + ANCHOR - 1
        key = np.full(len(at), U64(r * 64 + kind + 1))
        chosen = set(steps.tolist())
        for j, factor in enumerate(factors):
            symbol = flat[np.clip(at, 0, len(flat) - 1)]
            if j in chosen:
                key = finalize(key * U64(0xD6E8FEB86659FD93) + symbol)
                good = (at >= low) & (at < high)  # a walk that has left doesn't come back
            at = at + way * ((symbol * factor) >> U64(63)).astype(np.int64)
        yield key, good


def padded(flat: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """Rows flat[start:start + width]; places outside low..high hold 0."""
    place = start[:, None] + np.arange(width)[None, :]
    inside = (place >= low[:, None]) & (place < high[:, None])
    if not len(flat):
        return np.zeros(place.shape, U64)
    return np.where(inside, flat[np.clip(place, 0, len(flat) - 1)], U64(0))


def spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the places first[row] up to first[row] + count[row]."""
    row = np.repeat(np.arange(len(first)), count)
    return row, first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def segment_anchors(hashes: np.ndarray, bounds: np.ndarray, edits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, place in it, hash) of the rarest three words of each of an item's k + 1 segments."""
    anchors, first = shingles_of(Words(bounds, bounds, hashes, bounds), ANCHOR)
    _, back, count = np.unique(anchors, return_inverse=True, return_counts=True)
    rank = np.full(len(hashes), len(hashes) + 1)
    rank[first] = count[back]
    value = np.zeros(len(hashes), U64)
    value[first] = anchors
    item, place = [], []
    for k, n in enumerate(np.diff(bounds)):
        cuts = np.linspace(0, n, edits[k] + 2).astype(int) if n >= ANCHOR else ()
        for a, b in zip(cuts[:-1], cuts[1:]):
            item.append(k)
            place.append(a + int(np.argmin(rank[bounds[k] + a : bounds[k] + b - ANCHOR + 1])))
    item, place = np.array(item, np.int64), np.array(place, np.int64)
    return item, place, value[bounds[item] + place]


def build_index(items: list[tuple[int | None, str | None]]) -> Index | None:
    """The index of the items that have a word, or None without any."""
    order = sorted(((i, t) for i, t in items if t), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    hashes = []
    for _, _, texts in groups(pa.array([t for _, t in order], pa.string())):
        words = plain_words(texts)
        hashes += [words.hash[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    good = [k for k, h in enumerate(hashes) if len(h)]
    if not good:
        return None
    hashes = [hashes[k] for k in good]
    size = np.array([len(h) for h in hashes])
    flat = np.concatenate(hashes)
    bounds = np.concatenate(([0], np.cumsum(size)))
    edits = allowed_edits(size)
    item, place, value = segment_anchors(flat, bounds, edits)
    kinds = size_class(size)[item]
    laid = np.unique(np.stack((value, kinds.astype(U64)), 1), axis=0)
    keys, whose, where = [], [], []
    for kind in np.unique(kinds).tolist():
        of, at = item[kinds == kind], place[kinds == kind]
        for key, inside in bucket_keys(flat, bounds[of] + at, bounds[of], bounds[of + 1], kind):
            keys.append(key[inside])
            whose.append(of[inside])
            where.append(at[inside])
    keys = np.concatenate(keys) if keys else np.zeros(0, U64)
    by = np.argsort(keys, kind="stable")
    return Index(
        np.array([order[k][0] for k in good], object),  # None where the item has no id
        size,
        edits,
        flat,
        bounds,
        {short_hash(h): k for k, h in reversed(list(enumerate(hashes))) if len(h) < ANCHOR},
        laid[:, 0],
        laid[:, 1].astype(np.int64),
        keys[by],
        np.concatenate(whose)[by] if whose else np.zeros(0, np.int64),
        np.concatenate(where)[by] if where else np.zeros(0, np.int64),
    )


def short_hash(words: np.ndarray) -> int:
    return int(fold([words[j : j + 1] for j in range(len(words))])[0]) ^ len(words)


def matches(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of keys, row of the sorted table) of every equal pair."""
    low = np.searchsorted(table, keys, "left")
    return spread(low, np.searchsorted(table, keys, "right") - low)


def windows_of(words: Words, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, size class) of the windows that an anchor lays, each once."""
    hashes, first = shingles_of(words, ANCHOR)
    row, anchor = matches(index.anchor_hash, hashes)
    place, kind = first[row], index.anchor_class[anchor]
    return words.text_of()[place], place, kind


def candidate_runs(
    words: Words, index: Index, text: np.ndarray, place: np.ndarray, kind: np.ndarray, done: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``candidates_of`` for the windows in runs that have up to CANDIDATES: windows are halved where they have more. Near-equal items
    share buckets, and each window meets them all. Windows of texts that are done are left out."""
    on = ~done[text]
    text, place, kind = text[on], place[on], kind[on]
    found = candidates_of(words, index, text, place, kind)
    if found is not None:
        yield found
        return
    half = len(text) // 2
    for part in (slice(half), slice(half, None)):
        yield from candidate_runs(words, index, text[part], place[part], kind[part], done)


def candidates_of(
    words: Words, index: Index, text: np.ndarray, place: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(text, item, first word of the item's copy if nothing was edited before) of the items that share a bucket with a window.

    None if several windows have more than CANDIDATES together. Bucket entries are met MET at a time.
    """
    reach = int(index.size.max())  # a copy may begin so many words ahead of the first word
    n_items, n_starts = len(index.size), len(words.hash) + reach + 1
    least = int(text.min()) if len(text) else 0
    if len(text) > 1 and (int(text.max()) - least + 1) * n_items * n_starts >= 1 << 63:  # too many for one number
        return None
    found = np.zeros(0, np.int64)
    for one in np.unique(kind).tolist():
        t, p = text[kind == one], place[kind == one]
        new = []
        for key, inside in bucket_keys(words.hash, p, words.bounds[t], words.bounds[t + 1], one):
            window = np.flatnonzero(inside)
            low = np.searchsorted(index.bucket_key, key[inside], "left")
            count = np.searchsorted(index.bucket_key, key[inside], "right") - low
            hit = count > 0
            window, low, count = window[hit], low[hit], count[hit]
            cuts = np.flatnonzero(np.diff(np.cumsum(count) // MET)) + 1
            for w, first, many in zip(*(np.split(x, cuts) for x in (window, low, count))):
                row, bucket = spread(first, many)
                start = p[w[row]] - index.bucket_place[bucket] + reach
                new.append(((t[w[row]] - least) * n_items + index.bucket_item[bucket]) * n_starts + start)
                if sum(map(len, new)) > MET:
                    found = np.unique(np.concatenate((found, *new)))
                    new = []
                    if len(found) > CANDIDATES and len(text) > 1:
                        return None
        found = np.unique(np.concatenate((found, *new)))
    if len(found) > CANDIDATES and len(text) > 1:
        return None
    of, start = np.divmod(found, n_starts)
    t, item = np.divmod(of, n_items)
    return t + least, item, start - reach


def regions_of(
    words: Words, index: Index, text: np.ndarray, item: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, first word, word after the last) to verify: runs of windows of an item whose starts lie together.

    A leak begins at most k words before or after its window; a run of starts is at most the item's size long.
    """
    if not len(text):
        return text, item, start, start
    low, rows = 0, []
    reach = index.edits[item] + 1
    together = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (start[1:] - start[:-1] <= reach[1:])
    for k in range(1, len(text) + 1):
        if k == len(text) or not together[k - 1] or start[k] - start[low] > index.size[item[k]]:
            rows.append((low, k - 1))
            low = k
    first, last = np.array(rows).T
    t, i = text[first], item[first]
    begin = np.maximum(start[first] - index.edits[i], words.bounds[t])
    end = np.minimum(start[last] + index.size[i] + index.edits[i], words.bounds[t + 1])
    return t, i, begin, end


def may_hold(words: Words, index: Index, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of the regions in which enough of the item's words stand, in any order, to be within k edits."""
    row, place = spread(begin, end - begin)
    there = np.unique(finalize(words.hash[place] + row.astype(U64) * U64(0x9E3779B97F4A7C15)))
    row, place = spread(index.bounds[item], index.size[item])
    own = finalize(index.symbols[place] + row.astype(U64) * U64(0x9E3779B97F4A7C15))
    stands = there[np.minimum(np.searchsorted(there, own), len(there) - 1)] == own
    common = np.bincount(row[stands], minlength=len(item))
    return common >= index.size[item] - index.edits[item]


def edit_rows(runs: np.ndarray, symbols: np.ndarray, size: np.ndarray, anywhere: bool) -> np.ndarray:
    """Edits between each row's symbols (the first ``size``) and the part of its run up to each place.

    The part begins at the run's start, or anywhere.
    """
    steps = np.arange(runs.shape[1] + 1)
    row = np.zeros((len(runs), len(steps)), np.int64) + (0 if anywhere else steps)
    for i in range(symbols.shape[1]):
        symbol = symbols[:, i][:, None]
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (runs != symbol), row[:, 1:] + 1)
        new = np.minimum.accumulate(new - steps, axis=1) + steps
        row = np.where((i < size)[:, None], new, row)
    return row


def edit_distances(
    words: Words, index: Index, item: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least edits, first word, word after the last) of the nearest run of words to each item in its region."""
    every = np.arange(len(item))
    first, size = index.bounds[item], index.size[item]
    longest = int(size.max())
    runs = padded(words.hash, begin, begin, end, int((end - begin).max()))
    rows = edit_rows(runs, padded(index.symbols, first, first, first + size, longest), size, True)
    best = rows.argmin(axis=1)
    edits, stop = rows[every, best], begin + best
    # backwards from its end the run begins where the edits are as few
    width = int((size + edits).max())
    back = padded(words.hash, stop - width, begin, stop, width)[:, ::-1]
    mirrored = padded(index.symbols, first + size - longest, first, first + size, longest)[:, ::-1]
    rows = edit_rows(back, mirrored, size, False)
    return edits, stop - rows.argmin(axis=1), stop


def whole_leaks(words: Words, index: Index) -> np.ndarray:
    """Rows of ``leaks_in`` for items of fewer than ANCHOR words."""
    counts = words.counts
    rows = []
    for t in np.flatnonzero((counts > 0) & (counts < ANCHOR)).tolist() if index.whole else ():
        item = index.whole.get(short_hash(words.hash[words.bounds[t] : words.bounds[t + 1]]))
        if item is not None:
            rows.append((t, item, 0, 0, int(counts[t])))
    return np.array(rows, np.int64).reshape(-1, 5)


def leaks_in(texts: Texts, index: Index, any_item: bool = False) -> np.ndarray:
    """Rows (text, item, edits, first word, word after the last), one per text and item; any_item: some of them, for every text that has any."""
    words = plain_words(texts)
    found = [whole_leaks(words, index)]
    done = np.zeros(texts.n, bool)  # stays so unless any item will do
    if any_item:
        done[found[0][:, 0]] = True
    windows = windows_of(words, index)
    parts = [windows]
    if any_item:  # a few windows of each text first
        early = np.arange(len(windows[0])) - np.searchsorted(windows[0], windows[0]) < EARLY
        parts = [[w[early] for w in windows], [w[~early] for w in windows]]
    for part in parts:
        for candidates in candidate_runs(words, index, *part, done):
            for rows in verified(words, index, *regions_of(words, index, *candidates), done if any_item else None):
                found.append(rows)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 4], rows[:, 2], rows[:, 1], rows[:, 0]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[fresh]


def verified(
    words: Words, index: Index, text: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray, done: np.ndarray | None
) -> Iterator[np.ndarray]:
    """Rows of ``leaks_in`` of the regions that hold a leak, a few regions at a time.

    Where ``done`` is given, of each text one region is looked at, then two, then four; texts marked in it meanwhile are left out.
    """
    if done is not None and len(text):
        nth = np.arange(len(text)) - np.searchsorted(text, text)
        wave = np.frexp(nth + 1)[1]
        for n in range(1, int(wave.max()) + 1):
            now = (wave == n) & ~done[text]
            for rows in verified(words, index, text[now], item[now], begin[now], end[now], None):
                done[rows[:, 0]] = True
                yield rows
        return
    by = np.argsort(begin - end, kind="stable")
    text, item, begin, end = text[by], item[by], begin[by], end[by]
    a = 0
    while a < len(text):
        b = a + min(max(CELLS // (2 * int(end[a] - begin[a])), 1), WINDOWS)
        t, k, s, e = text[a:b], item[a:b], begin[a:b], end[a:b]
        a = b
        mask = may_hold(words, index, k, s, e)
        t, k, s, e = t[mask], k[mask], s[mask], e[mask]
        if len(t):
            edits, first, stop = edit_distances(words, index, k, s, e)
            good = edits <= index.edits[k]
            base = words.bounds[t]
            yield np.stack((t, k, edits, first - base, stop - base), 1)[good]


def item_blocks(items: DataFrame) -> list[list[tuple[int | None, str | None]]]:
    """The items in blocks of about BLOCK_BYTES, collected one at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    rows = items.where(F.col("text").isNotNull()).select("item_id", "text")
    named, nameless = rows.where("item_id IS NOT NULL"), rows.where("item_id IS NULL")
    if not nameless.isEmpty():
        rows = named.unionByName(nameless.join(named.select("text"), "text", "left_anti"))
    return ([tuple(r) for r in rows.where(part == k).collect()] for k in range(n))


SCHEMA = "doc_id bigint, item_id bigint, item_words bigint, edits bigint, first_word bigint, end_word bigint"


@dataclass(frozen=True)
class Block:
    """A block of items as it goes to the executors."""

    name: str
    items: Broadcast


INDEXES: dict[str, Index | None] = {}


def index_of(block: Block) -> Index | None:
    """The block's index, built once in each process; the last one is kept."""
    if block.name not in INDEXES:
        INDEXES.clear()
        INDEXES[block.name] = build_index(block.items.value)
    return INDEXES[block.name]


def blocks_of(items: DataFrame) -> Iterator[Block]:
    context = items.sparkSession.sparkContext
    return (Block(uuid.uuid4().hex, context.broadcast(rows)) for rows in item_blocks(items))


def finder(block: Block) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(block)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches if index else ():
            ids = batch.column("doc_id").cast(pa.int64())
            for at, _, texts in groups(batch.column("text"), SEARCHED_BYTES):
                rows = leaks_in(texts, index)
                if len(rows):
                    columns = [ids.take(pa.array(rows[:, 0] + at)), pa.array(index.ids[rows[:, 1]], pa.int64())]
                    columns += [pa.array(index.size[rows[:, 1]])] + [pa.array(rows[:, j]) for j in (2, 3, 4)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row and item that leaks into it."""
    found = [docs.select("doc_id", "text").mapInArrow(finder(block), SCHEMA) for block in blocks_of(items)]
    empty = docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, found) if found else empty


def dropper(block: Block) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(block)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for at, _, texts in groups(batch.column("text"), SEARCHED_BYTES) if index else ():
                keep[at + leaks_in(texts, index, any_item=True)[:, 0]] = False
            yield batch.filter(pa.array(keep))

    return run


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, into which no item leaks."""
    return reduce(lambda left, block: left.mapInArrow(dropper(block), left.schema), blocks_of(items), docs)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
