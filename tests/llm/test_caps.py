import math

import numpy as np
import pytest

from tests.llm.helpers import components
from tierlake.llm import caps
from tierlake.llm.common import configure


def plain(rows, threshold):
    """(id, vector) rows -> (id, n_links, component, kept) rows."""

    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    vectors = [np.array(v, float) if fine(v) else None for _, v in rows]
    pairs = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if vectors[a] is not None and vectors[b] is not None and len(vectors[a]) == len(vectors[b])
        and vectors[a] @ vectors[b] / (np.linalg.norm(vectors[a]) * np.linalg.norm(vectors[b])) >= threshold]
    degree = [0] * len(rows)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    root = components(range(len(rows)), pairs)
    smallest = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            smallest[root[i]] = min(smallest.get(root[i], vec_id), vec_id)
    return sorted([(i, degree[n], smallest.get(root[n], i), i is not None and smallest.get(root[n]) == i)
                   for n, (i, _) in enumerate(rows)], key=str)


def got(spark, rows, threshold=0.95):
    configure(spark)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted([tuple(r) for r in caps.near_duplicates(frame, threshold).collect()], key=str)


def test_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0]), (11, [3.0]),
            (None, [1.0, 0.0]), (2, [2.0, 0.0]), (12, [1.0, 0.1]), (13, [-1.0, 0.0]), (14, [1e-30, 0.0])]
    assert got(spark, rows) == plain(rows, 0.95)
    assert got(spark, []) == []


@pytest.mark.parametrize("block", [7, 1024])
def test_crowded_caps_are_cut_into_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    draw = np.random.default_rng(4)
    centre = draw.standard_normal(24)
    near = [(centre + draw.standard_normal(24) * 0.15).tolist() for _ in range(80)]
    rows = list(enumerate([*near, *draw.standard_normal((60, 24)).tolist(), *[near[0]] * 30]))
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    assert got(spark, rows) == plain(rows, 0.95)


def spread(kind, draw, rows, size):
    """Rows whose length lies in few components."""
    scale = {"decaying": 1 / np.arange(1, size + 1), "one part": np.where(np.arange(size) < size // 3, 1, 0.05),
             "sparse": np.ones(size)}[kind]
    keep = draw.random((rows, size)) < 3 / size if kind == "sparse" else np.ones((rows, size))
    return draw.standard_normal((rows, size)) * scale * keep + draw.standard_normal((rows, size)) * 0.001


def close_pairs(kind, rows):
    draw = np.random.default_rng(12)
    base, noise = spread(kind, draw, rows, 64), spread(kind, draw, rows, 64)
    noise -= (noise * base).sum(1, keepdims=True) / (base**2).sum(1, keepdims=True) * base
    scale = np.linalg.norm(base, axis=1) / np.linalg.norm(noise, axis=1) * math.tan(math.acos(0.952))
    return base, base + noise * scale[:, None]


@pytest.mark.parametrize("words", [12, 60, 171])
@pytest.mark.parametrize("kind", ["decaying", "one part", "sparse"])
def test_close_pairs_meet_where_few_components_hold_the_length(kind, words):
    codes, missed = caps.codes_needed(64, words, 0.95), 0
    for a, b in zip(*close_pairs(kind, 300)):
        a, b = (caps.caps(x / np.linalg.norm(x), words, codes) for x in (a, b))
        missed += not np.isin(a, b).any()
    assert missed <= 1


def test_recall_where_one_part_holds_the_length(spark, monkeypatch):
    monkeypatch.setattr(caps, "code_size", lambda vectors: 171)
    rows = list(enumerate(np.concatenate(close_pairs("one part", 150)).astype(np.float32).tolist()))
    expected = sum(n for _, n, _, _ in plain(rows, 0.95))
    found = sum(n for _, n, _, _ in got(spark, rows))
    assert 0.99 * expected <= found <= expected


@pytest.mark.parametrize("dimension, words", [(2, 20), (3, 20), (48, 20), (64, 171)])
def test_codes_keep_the_miss_probability(dimension, words):
    draw, codes = np.random.default_rng(5), caps.codes_needed(dimension, words, 0.95)
    missed = 0
    for _ in range(500):
        a, b = np.linalg.qr(draw.standard_normal((dimension, 2)))[0].T
        b = 0.95 * a + math.sqrt(1 - 0.95**2) * b
        missed += not np.isin(caps.caps(a, words, codes), caps.caps(b, words, codes)).any()
    assert missed <= 1


def test_recall_of_links(spark):
    draw = np.random.default_rng(9)
    base = draw.standard_normal((700, 48))
    noise = draw.standard_normal((700, 48))
    noise -= (noise * base).sum(1, keepdims=True) / (base**2).sum(1, keepdims=True) * base
    scale = np.linalg.norm(base, axis=1) / np.linalg.norm(noise, axis=1) * math.tan(math.acos(0.952))
    pairs = np.concatenate([base, base + noise * scale[:, None]]).astype(np.float32).tolist()
    rows = list(enumerate(pairs))
    expected = sum(n for _, n, _, _ in plain(rows, 0.95))
    found = sum(n for _, n, _, _ in got(spark, rows))
    assert 0.99 * expected <= found <= expected


@pytest.mark.parametrize("dimension, words", [(1, 4), (2, 9), (7, 5), (48, 20), (64, 40)])
def test_decoding_equals_all_products(dimension, words):
    """The filters of a vector are those whose product reaches the line, over all of them."""
    draw = np.random.default_rng(dimension)
    for _ in range(20):
        unit = draw.standard_normal(dimension)
        unit /= np.linalg.norm(unit)
        rotation, books = caps.codebooks(dimension, words, 3)
        products = [book @ part for book, part in zip(books, np.array_split(rotation @ unit, caps.PARTS))]
        every = (products[0][:, None, None] + products[1][None, :, None] + products[2][None, None, :]).ravel()
        got = np.sort(caps._of_code(unit, words, 3) - 3 * len(every))
        line = every[got].min()
        assert len(got) >= min(caps.LEAST, len(every))
        assert set(got.tolist()) == set(np.flatnonzero(every >= line - 1e-9).tolist()) or (
            set(np.flatnonzero(every >= line + 1e-9).tolist()) <= set(got.tolist()))


def test_decoding_visits_few_filters():
    """Time per vector grows far less than the number of pairs of codewords."""
    import time

    draw, spent = np.random.default_rng(1), []
    for vectors in (5_000_000, 500_000_000):
        words = caps.code_size(vectors)
        units = draw.standard_normal((60, 64))
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        caps._of_code(units[0], words, 0)
        began = time.perf_counter()
        for unit in units:
            caps._of_code(unit, words, 0)
        spent.append(time.perf_counter() - began)
    assert spent[1] < 6 * spent[0]


def test_component_with_half_of_the_vectors_is_split(spark):
    draw = np.random.default_rng(2)
    steps = np.cumsum(draw.standard_normal((600, 24)) * 0.05, axis=0) + draw.standard_normal(24) * 3
    rows = list(enumerate(np.concatenate([steps, draw.standard_normal((600, 24))]).astype(np.float32).tolist()))
    rows += [(2000 + i, rows[0][1]) for i in range(600)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before, plans = {k: spark.conf.get(k) for k in settings}, []
    write = caps.Scratch.write

    def seen(self, df, label):
        found = write(self, df, label)
        if label == "final":
            df.collect()
            plans.append(df._jdf.queryExecution().toString())
        return found

    for k, v in settings.items():
        spark.conf.set(k, v)
    caps.Scratch.write = seen
    try:
        assert got(spark, rows) == plain(rows, 0.95)
    finally:
        caps.Scratch.write = write
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "component" in plans[0] and "SortMergeJoin" in plans[0]
