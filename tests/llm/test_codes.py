import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from tierlake.llm import codes
from tierlake.llm.common import configure


def plain(rows):
    """The same with Python's integers and every distance."""
    fine = [(i, [math.floor(Fraction(x) * 4096) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not fine:
        return []
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(fine[0][1])
    fine = [r for r in fine if len(r[1]) == width]
    edges = np.cumsum([0, *[len(x) for x in np.array_split(np.arange(width), 8)]]).tolist()
    parts = [[v[a:b] for _, v, _ in fine] for a, b in zip(edges, edges[1:])]
    books = [own[:16] for own in parts]

    def assign(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), n) for n, entry in enumerate(book))

    for _ in range(6):
        for at, own in enumerate(parts):
            near = [assign(books[at], part)[1] for part in own]
            books[at] = [
                [sum(c) // near.count(n) for c in zip(*[p for p, m in zip(own, near) if m == n])] if n in near else entry
                for n, entry in enumerate(books[at])]
    found = [[assign(books[at], part) for part in own] for at, own in enumerate(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(found[at][n][0] for at in range(8)) for n in range(len(fine))]
    by_label = {}
    for (_, _, label), error in zip(fine, errors):
        by_label[label] = by_label.get(label, 0) + error

    def fits(x):
        return x if x < 1 << 63 else None

    return sorted([
        (i, "".join(f"{found[at][n][1]:02x}" for at in range(8)), fits(errors[n]),
         fits(by_label[label]) if all(fits(e) is not None for (_, _, l), e in zip(fine, errors) if l == label) else None,
         digest) for n, (i, _, label) in enumerate(fine)], key=str)


def got(spark, rows, kind="float"):
    configure(spark)
    frame = spark.createDataFrame(
        [(*r, 1, 2.0, [0.5]) for r in rows],
        f"vec_id long, embedding array<{kind}>, label int, code int, error double, vector array<double>")
    return sorted([tuple(r) for r in codes.compress(frame).collect()], key=str)


def drawn(n, width, kind=np.float32, spread=0.3):
    draw = np.random.default_rng(n)
    centres = draw.standard_normal((5, width))
    return [(centres[i % 5] + draw.standard_normal(width) * spread).astype(kind).tolist() for i in range(n)]


@pytest.mark.parametrize("n, width", [(3, 16), (200, 32), (150, 21), (40, 8), (20, 3)])
def test_equals_brute_force(spark, n, width):
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(drawn(n, width))]
    assert got(spark, rows) == plain(rows)


def test_edges(spark):
    good = drawn(30, 16)
    rows = [(i, v, 7) for i, v in enumerate(good)]
    rows += [(-1, None, 1), (-2, [], 1), (-3, [None] * 16, 1), (-4, [float("nan")] * 16, 1), (-5, [math.inf] * 16, 1),
             (50, [1.0] * 8, 1), (None, good[3], None), (4, good[4], 7), (4, good[4], 7), (60, [0.0] * 16, None),
             (61, [-0.0] * 16, None), (62, [1e-40] * 16, None), (63, [-1e-40] * 16, None)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [float(i % 4)] * 8, 1) for i in range(40)] + [(50, [0.5] * 8, 1), (51, [1.5] * 8, 1)]
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("kind, size", [("float", 3e38), ("double", 1e300), ("float", 1e6), ("double", 2.0 ** 40)])
def test_large_components(spark, kind, size):
    rows = [(i, [x * size / 8 for x in v], i % 2) for i, v in enumerate(drawn(25, 16, np.float64))]
    rows = [(i, np.array(v, np.float32 if kind == "float" else np.float64).tolist(), label) for i, v, label in rows]
    rows += [(100 + i, v, 1) for i, v in enumerate(drawn(10, 16))]
    assert got(spark, rows, kind) == plain(rows)


def test_pivots_prune_and_lose_nothing(monkeypatch):
    part, entries = (np.array(drawn(n, 8, spread=0.1)) * 4096 for n in (3000, 16))
    part, entries = part.astype(np.int64), entries.astype(np.int64)
    pivots = codes.choose_pivots(entries)
    seen = []
    exact = codes.squared
    monkeypatch.setattr(codes, "squared", lambda a, b: seen.append(len(a)) or exact(a, b))
    to_pivots = codes.pivot_distances(part, pivots)
    seen.clear()
    index, best = codes.nearest(part, to_pivots, entries, pivots)
    every = ((part[:, None] - entries[None]) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (best == every.min(1)).all()
    assert sum(seen) < 0.6 * every.size
