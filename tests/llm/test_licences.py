from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from waymark.llm import licences as L
from waymark.llm.tokens import groups

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PLANTED = {
    "GPL": r"This work is licensed under the GNU General Public License, version \d",
    "CC-BY-NC": r"Licensed under CC BY-NC \d\.\d",
    "MIT": r"Released under the MIT License",
    "Apache-2.0": r"Licensed under the Apache License, Version \d\.\d",
}


@pytest.fixture(scope="module")
def model(spark, sf):
    return L.train(spark.read.parquet(f"{sf}/documents.parquet"))


def test_planted_notices(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {
        (r.doc_id, family, m.start(), m.end())
        for r in docs.collect()
        for family, pattern in PLANTED.items()
        for m in re.finditer(pattern, r.text)
    }
    got = {(r.doc_id, n.family, n.start, n.end) for r in L.scan(docs, model).collect() for n in r.notices}
    assert got == want and len(want) > 10


def test_held_out_variants(model):
    rng = np.random.default_rng(99)
    fill = np.array(["alpha", "beta", "the", "of", "code"])
    right = total = 0
    for family, texts in L.NOTICES.items():
        for text in texts:
            for _ in range(5):
                _, _, t = next(groups(pa.array([L.varied(rng, text, fill)])))
                total += 1
                right += family in {n["family"] for n in L.notices_in(t, model)[0]}
    assert right >= 0.9 * total, right / total


#: Wordings that neither the notices nor their variations have.
WORDINGS = {
    "This file is made available to you under the Apache License, Version 2.0; see LICENSE.": "Apache-2.0",
    "Code in this folder is distributed under the terms of the MIT License, see the file COPYING.": "MIT",
    "The software is provided “as is”, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability and fitness for a particular purpose.": "MIT",
    "You can redistribute this package and/or modify it under the terms of the GNU General Public License, version 2, as published by the Free Software Foundation.": "GPL",
    "You should have received a copy of the GNU Lesser General Public License along with this library; this library is free software.": "LGPL",
    "This server is free software, licensed under the GNU Affero General Public License, version 3 or later.": "AGPL",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation.": "BSD",
    "This Source Code is subject to the terms of the Mozilla Public License, v. 2.0 and later.": "MPL-2.0",
    "All pictures here are licensed under a Creative Commons Attribution 4.0 International License unless noted.": "CC-BY",
    "All materials are made available under the terms of the Eclipse Public License 2.0 by their authors.": "EPL-2.0",
    "What follows is free and unencumbered software released into the public domain by its author.": "Unlicense",
    "The library is distributed under the Boost Software License, Version 1.0, a copy of which comes with it.": "BSL-1.0",
    "Our typeface is licensed under the SIL Open Font License, Version 1.1, with reserved names.": "OFL-1.1",
}


def test_independent_wordings(model):
    _, _, t = next(groups(pa.array(list(WORDINGS))))
    found = [{n["family"] for n in f} for f in L.notices_in(t, model)]
    missed = [(x, f) for (x, family), f in zip(WORDINGS.items(), found) if family not in f]
    assert len(missed) <= 0.1 * len(WORDINGS), missed


def test_notices_inside_longer_paragraphs(model):
    before = "The code in this repository, with all documentation, tests and examples that members of the core team wrote over the years, is "
    pad = " ".join(["some words without a stop"] * 300)
    apache, mit, by = "licensed under the Apache License, Version 2.0", "released under the MIT License", "licensed under CC BY-SA 4.0"
    texts = [
        f"{before}{apache}.",
        f"é {pad} {apache} {pad} {apache} {pad}",
        f"{before}{mit}, while the pictures that come with it are {by} by those who drew them.",
        f"{before}not to be sold under any license, version or terms of the general public library of the state.",
        f"{before}{apache}. Released under the MIT License.",
    ]
    want = [[("Apache-2.0", apache)], [("Apache-2.0", apache)] * 2, [("MIT", mit), ("CC-BY-SA", by)], []]
    want += [[("Apache-2.0", apache), ("MIT", mit.capitalize().replace("mit license", "MIT License"))]]
    _, _, t = next(groups(pa.array(texts)))
    got = [[(n["family"], x[n["start"] : n["end"]]) for n in found] for x, found in zip(texts, L.notices_in(t, model))]
    assert got == want


def test_lookalikes_are_unknown(model):
    lines = L.LOOKALIKES + ["A license plate was found near the general store in the public park."]
    _, _, t = next(groups(pa.array(["\n".join(lines)])))
    assert L.notices_in(t, model) == [[]]


def test_edge_rows(spark, model):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, f"é\n{mit}"), (3, f"é\n{mit}"), (None, mit), (5, "pad\n" * 400_000 + mit), (6, "word " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, [(n.family, n.start, n.end) for n in r.notices]) for r in L.scan(docs, model).collect()]
    assert got == [
        (1, []),
        (2, []),
        (3, [("MIT", 2, 32)]),
        (3, [("MIT", 2, 32)]),
        (None, [("MIT", 0, 30)]),
        (5, [("MIT", 1_600_000, 1_600_030)]),
        (6, []),
    ]
    empty = spark.createDataFrame([], DOCS)
    assert L.scan(empty, L.train(empty)).count() == 0
