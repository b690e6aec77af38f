from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import tokens

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXT = st.text(alphabet="aAbZ \t\n\x0b\r\x0c\x1c\x85 éß語😀", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, min_size=1, max_size=12), st.integers(1, 40), st.integers(1, 30))
def test_words_of_any_texts(texts, piece, size):
    column = pa.array(["skipped", *texts], pa.string())[1:]
    seen, hashes = [], {}
    before, tokens.PIECE_BYTES = tokens.PIECE_BYTES, piece
    try:
        for at, to, group in tokens.groups(column, size):
            assert group.n == to - at and at == len(seen)
            words = tokens.words_of(group, lower=False)
            for i in range(group.n):
                own = [
                    (group.data[s:e].tobytes(), int(h))
                    for s, e, h in list(zip(words.start, words.end, words.hash))[words.bounds[i] : words.bounds[i + 1]]
                ]
                hashes.update(own)
                seen.append([w for w, _ in own])
                assert all(hashes[w] == h for w, h in own)
    finally:
        tokens.PIECE_BYTES = before
    assert seen == [WORD.findall((t or "").encode()) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(1, 5))
def test_shingle_sets(texts, size):
    _, _, group = next(tokens.groups(pa.array(texts), 1 << 20))
    sets = tokens.shingle_sets(tokens.words_of(group), size)
    lower = lambda w: re.sub(rb"[A-Z]", lambda m: m[0].lower(), w)
    want = []
    for t in texts:
        w = [lower(x) for x in WORD.findall(t.encode())]
        want.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    assert [len(s) for s in sets] == [len(s) for s in want]
    for a, x in zip(sets, want):
        for b, y in zip(sets, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_a_long_word_has_the_hash_of_its_bytes():
    from waymark.llm import tokens as T

    long = "aB" * T.PIECE_BYTES + "é"
    said = [f"x {long} y", long, f"x{long}", "a b " * 200_000 + long + " end"]
    _, _, texts = next(T.groups(pa.array(said), 1 << 40))
    words = T.words_of(texts)
    want = 0
    for b in reversed(long.lower().encode()):
        want = (want * T.BASE + b + 1) % (1 << 64)
    want = T.finalize(np.array([want ^ (len(long.encode()) << 48) % (1 << 64)], np.uint64))[0]
    own = [words.hash[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    assert own[0][1] == own[1][0] == own[3][-2] == want != own[2][0]
    assert [len(o) for o in own] == [3, 1, 1, 400_002] and own[0][0] == T.words_of(next(T.groups(pa.array(["x"])))[2]).hash[0]
