"""Licence scans: a trained paragraph classifier, confirmed against templates.

Paragraphs are sentences or lines: a text is cut at line ends and after . ! ? before a
blank. Each is a bag of hashed word unigrams and bigrams (A-Z lower-cased, ASCII punctuation read as blanks), and a
sparse multinomial logistic regression names its licence family or the class "unknown".
It is trained by stochastic gradient descent in numpy on the notices below, with words
dropped, replaced and added at random, against paragraphs of a bounded sample of documents
and the look-alikes below. Temperature and threshold are calibrated on examples that training
did not see. A prediction counts once the paragraph also resembles a notice of that family.
Where a longer paragraph holds most bigrams of a notice in a run of words about as long as
the notice, that run is scored by itself.

Defined results:
- null and empty texts have no notice; every row comes back, repeated rows with equal results;
- adjacent paragraphs of one family are one notice, a notice inside a longer paragraph stands for itself;
  spans are in code points, end exclusive;
- an empty table gives no rows (the model is then trained on the notices alone);
- further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import PLAIN, spread
from .tokens import IS_BLANK, U64, Texts, Words, finalize, groups, words_of

BUCKETS = 1 << 18
#: The bound of the sample of documents that gives paragraphs without a licence: rows, characters of a row,
#: paragraphs drawn from these, and paragraphs whose words vary the notices.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000
SAMPLE_PARAGRAPHS = 6_000
FILLER_PARAGRAPHS = 2_000
#: Least share of bigrams, of paragraph or notice, whichever has more, that confirms a prediction.
CONFIRMED = 0.4
#: A paragraph that is a part of a longer notice: least share of its bigrams, and least words.
CONTAINED, CONTAINED_WORDS = 0.75, 6
#: A notice inside a longer paragraph: least share and number of its bigrams that stand there,
#: in a run of at most so many times its length.
HELD, HELD_BIGRAMS, HELD_WITHIN = 0.75, 3, 1.5
UNKNOWN = "unknown"

# Usual notices of each family.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is licensed under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Released under the GNU LGPL v3.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "AGPL": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "This project is licensed under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, Version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "Zlib": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions.",
        "Released under the zlib License.",
        "SPDX-License-Identifier: Zlib",
    ],
    "OFL-1.1": [
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "SPDX-License-Identifier: OFL-1.1",
    ],
}
# Sentences that speak of licences and grant none.
LOOKALIKES = [
    "The driver must carry a valid license at all times.",
    "You can renew your fishing license online.",
    "The software license agreement ends when the contract ends.",
    "All rights reserved by the publisher.",
    "The public library is free and open on Sundays.",
    "She studied at MIT before she joined the firm.",
    "The Apache helicopter landed at the base.",
    "The general public was not admitted under the old rules.",
    "Version 3 of this work was released last year.",
    "He obtained a copy of the report under the terms of the agreement.",
    "The restaurant is licensed to sell beer and wine.",
    "This paper is under review and must not be distributed.",
]


@dataclass
class Paragraphs:
    """Paragraphs of some texts: words first[j]:last[j], bytes start[j]:end[j], of text text[j]."""

    words: Words
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return self.words.start[self.first]

    @property
    def end(self) -> np.ndarray:
        return self.words.end[self.last - 1]


def paragraphs_of(texts: Texts) -> Paragraphs:
    data = texts.data
    ends = (data == 46) | (data == 33) | (data == 63)
    before_blank = np.concatenate((IS_BLANK[data[1:]], [True])) if len(data) else np.zeros(0, bool)
    breaks = np.flatnonzero((data == 10) | (ends & before_blank))
    words = words_of(Texts(PLAIN[data], texts.offsets))
    if not len(words.start):
        none = np.zeros(0, np.int64)
        return Paragraphs(words, none, none, none)
    of = words.text_of()
    unit = np.searchsorted(breaks, words.start)
    fresh = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]) | (of[1:] != of[:-1]))))
    return Paragraphs(words, fresh, np.append(fresh[1:], len(unit)), of[fresh])


def grams_of(p: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
    """(hash, paragraph) of the unigrams and of the bigrams inside paragraphs."""
    h = p.words.hash
    of = np.repeat(np.arange(len(p.first)), p.last - p.first)
    inside = np.flatnonzero(of[1:] == of[:-1])
    pairs = finalize(h[inside] * U64(0xD6E8FEB86659FD93) + h[inside + 1])
    return np.concatenate((h, pairs)), np.concatenate((of, of[inside]))


def one(text: str) -> np.ndarray:
    """All grams of a text as one paragraph."""
    words = next(groups(pa.array([text])))[2]
    words = words_of(Texts(PLAIN[words.data], words.offsets))
    n = len(words.hash)
    return grams_of(Paragraphs(words, np.zeros(1, np.int64), np.array([n]), np.zeros(1, np.int64)))[0] if n else np.zeros(0, U64)


def bigrams(text: str) -> frozenset[int]:
    grams = one(text)
    n = (len(grams) + 1) // 2
    return frozenset((grams[n:] if n > 1 else grams).tolist())


@dataclass
class Model:
    families: list[str]  # the last is UNKNOWN
    weights: np.ndarray
    touched: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    notices: dict[str, list[frozenset[int]]]

    def __post_init__(self) -> None:
        every = [(family, own) for family, texts in self.notices.items() for own in texts]
        self.notice_family = [family for family, _ in every]
        self.notice_size = np.array([len(own) for _, own in every])
        pairs = sorted((g, k) for k, (_, own) in enumerate(every) for g in own)
        self.pair_hash = np.array([g for g, _ in pairs], U64)
        self.pair_notice = np.array([k for _, k in pairs])

    def probabilities(self, grams: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        bucket = (grams >> U64(64 - 18)).astype(np.int64)
        size = np.bincount(of, minlength=n)
        known = self.touched[bucket]
        bucket, of = bucket[known], of[known]
        logits = np.stack(
            [np.bincount(of, weights=self.weights[bucket, k], minlength=n) for k in range(len(self.families))], 1
        )
        return softmax((logits / np.maximum(size, 1)[:, None] + self.bias) / self.temperature)

    def resembles(self, own: frozenset[int], words: int, family: str) -> float:
        """The best share of bigrams in common with a notice of the family, 0 if too small."""
        best = 0.0
        for notice in self.notices[family]:
            common = len(own & notice)
            share = common / max(len(own), len(notice), 1)
            if share >= CONFIRMED:
                best = max(best, share)
            elif words >= CONTAINED_WORDS and common >= CONTAINED * len(own):
                best = max(best, common / len(own))
        return best


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def varied(rng: np.random.Generator, text: str, fill: np.ndarray) -> str:
    words = text.split()
    out = []
    for w in words:
        r = rng.random()
        if r < 0.06:
            continue
        out.append(str(rng.choice(fill)) if r < 0.12 else w)
        if rng.random() < 0.04:
            out.append(str(rng.choice(fill)))
    return " ".join(out or words)


def fit(sample: list[str], copies: int = 30, epochs: int = 4, seed: int = 13) -> Model:
    """Train on varied notices against paragraphs of the sampled texts that resemble none."""
    rng = np.random.default_rng(seed)
    families = [*NOTICES, UNKNOWN]
    notices = {f: [bigrams(t) for t in texts] for f, texts in NOTICES.items()}
    every = [n for texts in notices.values() for n in texts]
    negatives, fill = list(LOOKALIKES), ["the", "of", "and", "this", "code"]
    for _, _, texts in groups(pa.array(sorted(sample), pa.string())):
        found = paragraphs_of(texts)
        for s, e in zip(found.start.tolist(), found.end.tolist()):
            negatives.append(texts.data[s:e].tobytes().decode("utf-8", "replace"))
    fill = np.array(fill + [w for text in negatives[:FILLER_PARAGRAPHS] for w in text.split()])
    chosen = rng.permutation(len(negatives))[:SAMPLE_PARAGRAPHS]
    rows: list[tuple[int, np.ndarray]] = []
    for i in chosen:
        own = bigrams(negatives[i])
        if not any(len(own & n) >= 0.3 * max(len(own), 1) for n in every):
            rows += [(len(families) - 1, one(negatives[i]))] * (10 if i < len(LOOKALIKES) else 1)
    for k, texts in enumerate(NOTICES.values()):
        for text in texts:
            rows += [(k, one(text))] + [(k, one(varied(rng, text, fill))) for _ in range(copies)]
    rows = [(k, *np.unique((g >> U64(64 - 18)).astype(np.int64), return_counts=True)) for k, g in rows if len(g)]
    order = rng.permutation(len(rows))
    held, train = order[: len(rows) // 5], order[len(rows) // 5 :]
    weights = np.zeros((BUCKETS, len(families)), np.float32)
    bias = np.zeros(len(families), np.float32)
    total, done = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            k, grams, times = rows[i]
            rate = 4.0 * (1 - done / total)
            done += 1
            error = softmax(times @ weights[grams] / times.sum() + bias)
            error[k] -= 1
            weights[grams] -= (rate * times[:, None] * error).astype(np.float32)
            bias -= (0.02 * rate * error).astype(np.float32)
    logits = np.array([rows[i][2] @ weights[rows[i][1]] / rows[i][2].sum() + bias for i in held])
    truth = np.array([rows[i][0] for i in held])
    at = np.arange(len(held))
    temperature = min(
        (float(t) for t in np.geomspace(0.1, 10, 50)),
        key=lambda t: -float(np.log(softmax(logits / t)[at, truth] + 1e-12).mean()),
    )
    p = softmax(logits / temperature)
    none = truth == len(families) - 1
    threshold = float(np.quantile(p[none, :-1].max(axis=1), 0.999)) if none.any() else 0.5
    touched = np.abs(weights).sum(axis=1) > 0
    return Model(families, weights, touched, bias, temperature, min(max(threshold, 0.3), 0.7), notices)


def train(docs: DataFrame) -> Model:
    """A hash draw of about four times the sample comes first, so no task sends a whole sample to the driver."""
    spread = 1 << 30
    most = min(spread, 4 * SAMPLE_ROWS * spread // max(docs.count(), 1))
    h = F.xxhash64("doc_id", "text")
    rows = (
        docs.where((F.length("text") <= SAMPLE_CHARS) & (F.pmod(h, F.lit(spread)) < most))
        .select("text", h.alias("h"))
        .orderBy("h", "text")
        .limit(SAMPLE_ROWS)
        .collect()
    )
    return fit([r["text"] for r in rows])


NOTICE = pa.list_(
    pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("similarity", pa.float64())])
)
SCHEMA = (
    "doc_id bigint, notices array<struct<family:string,start:bigint,end:bigint,score:double,similarity:double>>"
)


@dataclass(frozen=True)
class Held:
    """Words first:last of a text's words, which hold this share of a family's notice."""

    first: int
    last: int
    family: str
    score: float
    similarity: float


def runs_of(p: Paragraphs, grams: np.ndarray, of: np.ndarray, model: Model) -> dict[int, list[tuple[int, int, int, int]]]:
    """By paragraph the runs (bigrams in common, first word, word after the last, notice) that hold most of a notice."""
    n, k = len(p.words.hash), len(model.notice_size)
    need = np.maximum(np.ceil(HELD * model.notice_size), HELD_BIGRAMS)
    inside = np.flatnonzero(of[1:n] == of[: n - 1])
    low = np.searchsorted(model.pair_hash, grams[n:], "left")
    row, pair = spread(low, np.searchsorted(model.pair_hash, grams[n:], "right") - low)
    at, key = inside[row], of[inside[row]] * k + model.pair_notice[pair]
    by = np.argsort(key, kind="stable")
    at, key, pair = at[by], key[by], pair[by]
    both, several = np.unique(np.unique(key * len(model.pair_hash) + pair) // len(model.pair_hash), return_counts=True)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    for own in both[several >= need[both % k]].tolist():
        a, b = np.searchsorted(key, [own, own + 1])
        places, pairs, notice = at[a:b].tolist(), pair[a:b].tolist(), own % k
        reach = int(HELD_WITHIN * model.notice_size[notice])
        for i, begin in enumerate(places):
            seen: set[int] = set()
            end = begin
            for place, one_pair in zip(places[i : i + reach], pairs[i : i + reach]):
                if place >= begin + reach:
                    break
                if one_pair not in seen:
                    seen.add(one_pair)
                    end = place
            if len(seen) >= need[notice]:
                runs.setdefault(own // k, []).append((len(seen), begin, end + 2, notice))
    return runs


def held_in(p: Paragraphs, grams: np.ndarray, of: np.ndarray, model: Model, told: dict[int, str]) -> dict[int, list[Held]]:
    """By paragraph the notices inside it, fullest runs first where they overlap; told[paragraph] is found already."""
    out: dict[int, list[Held]] = {}
    for j, runs in runs_of(p, grams, of, model).items():
        used: set[int] = set()
        found = []
        for common, a, b, notice in sorted(runs, key=lambda r: (-r[0], r[2] - r[1], r[1:])):
            family = model.notice_family[notice]
            if family == told.get(j) or not used.isdisjoint(range(a, b)):
                continue
            run = Paragraphs(Words(p.words.start[a:b], p.words.end[a:b], p.words.hash[a:b], np.array([0, b - a])),
                             np.zeros(1, np.int64), np.array([b - a]), np.zeros(1, np.int64))
            prob = model.probabilities(*grams_of(run), 1)[0]
            best = int(prob.argmax())
            if model.families[best] == family and prob[best] >= model.threshold:
                used.update(range(a, b))
                found.append(Held(a, b, family, float(prob[best]), common / int(model.notice_size[notice])))
        if found:
            out[j] = sorted(found, key=lambda h: h.first)
    return out


def notices_in(texts: Texts, model: Model) -> list[list[dict]]:
    p = paragraphs_of(texts)
    out: list[list[dict]] = [[] for _ in range(texts.n)]
    if not len(p.first):
        return out
    grams, of = grams_of(p)
    prob = model.probabilities(grams, of, len(p.first))
    best = prob.argmax(axis=1)
    hits = np.flatnonzero((best < len(model.families) - 1) & (prob[np.arange(len(best)), best] >= model.threshold))
    whole: dict[int, float] = {}
    for j in hits.tolist():
        own = bigrams(texts.data[p.start[j] : p.end[j]].tobytes().decode("utf-8", "replace"))
        similarity = model.resembles(own, int(p.last[j] - p.first[j]), model.families[best[j]])
        if similarity:
            whole[j] = similarity
    held = held_in(p, grams, of, model, {j: model.families[best[j]] for j in whole})
    if not whole and not held:
        return out
    points = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    previous = (-2, None)
    for j in sorted(whole.keys() | held.keys()):
        i = int(p.text[j])
        base = points[texts.offsets[i]]
        if j in whole:
            family, similarity, score = model.families[best[j]], whole[j], float(prob[j, best[j]])
            start, end = int(points[p.start[j]] - base), int(points[p.end[j]] - base)
            if previous[0] == j - 1 and out[i] and previous[1] is out[i][-1] and previous[1]["family"] == family:
                last = out[i][-1]
                last["end"] = end
                last["score"], last["similarity"] = max(last["score"], score), max(last["similarity"], similarity)
            else:
                out[i].append({"family": family, "start": start, "end": end, "score": score, "similarity": similarity})
            previous = (j, out[i][-1])
        for h in held.get(j, []):
            s, e = p.words.start[h.first], p.words.end[h.last - 1]
            out[i].append(
                {
                    "family": h.family,
                    "start": int(points[s] - base),
                    "end": int(points[e] - base),
                    "score": h.score,
                    "similarity": h.similarity,
                }
            )
    return out


def scanner(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in groups(batch.column("text")):
                columns = [batch.column("doc_id")[at:to].cast(pa.int64()), pa.array(notices_in(texts, model), NOTICE)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "notices"])

    return run


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and its notices, of every row; one pass, no shuffle."""
    return docs.select("doc_id", "text").mapInArrow(scanner(model), SCHEMA)


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the families found (sorted, each once), their number, and the spans as family:start:end."""
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, train(docs))
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["family"]))), ",").alias("families"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(
            F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["start"], n["end"])), ","
        ).alias("spans"),
    )
