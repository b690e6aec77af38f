from __future__ import annotations

import random
from math import isqrt

import pytest

from waymark.operators import clusters as C

PLACE = "id string, lng double, lat double"


def sweep(nodes, zoom):
    """One level, node by node, in the order of colours, points and ids."""
    r = C.radius_at(zoom)
    side = isqrt(r * r // 2)
    order = sorted(nodes, key=lambda i: ((nodes[i][2] // side % 3) * 3 + nodes[i][3] // side % 3, -nodes[i][1], i))
    free, out, taken = dict.fromkeys(order), {}, {}
    for i in order:
        if i not in free:
            continue
        _, _, x, y = nodes[i]
        group = [j for j in free if (nodes[j][2] - x) ** 2 + (nodes[j][3] - y) ** 2 <= r * r]
        for j in group:
            del free[j]
        total = sum(nodes[j][1] for j in group)
        if len(group) > 1 and total >= 3:
            name = f"{zoom}:{i}"
            out[name] = (zoom, total, *(sum(nodes[j][1] * nodes[j][c] for j in group) // total for c in (2, 3)))
            taken |= {j: (*nodes[j], name) for j in group}
        else:
            out |= {j: nodes[j] for j in group}
    return out, taken


def brute(nodes, first, last):
    tree = {}
    for zoom in range(first, last - 1, -1):
        nodes, taken = sweep(nodes, zoom)
        tree |= taken
    return tree | {i: (*v, None) for i, v in nodes.items()}


def town(rng, n, lng, lat, spread):
    return [(lng + rng.gauss(0, spread), lat + rng.gauss(0, spread)) for _ in range(n)]


@pytest.mark.parametrize("seed,first,last,few", [(1, 10, 7, 0), (2, 4, 2, 0), (3, 10, 0, 250), (4, 10, 0, 50_000)])
def test_equals_a_sweep_node_by_node(spark, monkeypatch, seed, first, last, few):
    monkeypatch.setattr(C, "FEW", few)  # from none to all levels in one task
    rng = random.Random(seed)
    at = town(rng, 150, 13.4, 52.5, 0.03) + town(rng, 80, -0.1, 51.5, 0.2) + town(rng, 60, 179.99, -89.0, 0.02)
    at += [(rng.uniform(-180, 180), rng.uniform(-85, 85)) for _ in range(60)] + [(13.4, 52.5)] * 5
    rows = [(f"p{n:03d}", *p) for n, p in enumerate(at)]
    rng.shuffle(rows)
    odd = [("none", None, 1.0), ("nan", float("nan"), 1.0), (None, 1.0, 1.0)]
    places = spark.createDataFrame(rows + odd, PLACE)
    nodes = {r.id: (first + 1, 1, r.x, r.y) for r in C.projected(places.where("id IS NOT NULL")).collect()}
    assert len(nodes) == len(rows)
    tree = C.cluster_tree(places, first, last)
    got = {r.id: (r.zoom, r.n, r.x, r.y, r.parent_id) for r in tree.collect()}
    want = brute(nodes, first, last)
    assert got == want
    for zoom in (first + 1, first, last):
        shown = C.visible(tree, zoom).collect()
        assert sum(r.point_count or 1 for r in shown) == len(rows)
        assert all((r.point_count is None) == (r.size is None) and abs(r.lat) < 86 for r in shown)
        assert len(shown) == sum(v[0] >= zoom and (v[4] is None or int(v[4].split(":")[0]) < zoom) for v in want.values())


def test_no_places(spark):
    assert C.cluster_tree(spark.createDataFrame([], PLACE), 1, 0).count() == 0


def test_settings_are_those_of_the_map():
    assert C.radius_at(10) * (512 << 10) == 20 << 31 and (C.LAST_ZOOM, C.LEAST_POINTS) == (10, 3)


def test_categories_in_language_order(spark):
    from waymark.operators import places as P

    words = ["Zoo", "café", "Cafe", "cafe", "Café", "cab", "zoo", "Étang", "etang", None]
    rows = spark.createDataFrame([(w,) for w in words + words], "category string")
    plain = lambda df: [r.category for r in df.collect()]
    assert plain(P.categories(rows, "UNICODE")) == [None, "cab", "cafe", "Cafe", "café", "Café", "etang", "Étang", "zoo", "Zoo"]
    assert plain(P.categories(rows)) == sorted(set(words) - {None}) or plain(P.categories(rows))[0] is None
    assert plain(P.distinct_by(rows, "UNICODE_CI")) == ["cab", "Cafe", "Café", "etang", "Étang", "Zoo"]
    assert plain(P.distinct_by(rows, "UNICODE_CI_AI")) == ["cab", "Cafe", "etang", "Zoo"]
