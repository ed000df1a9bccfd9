from fractions import Fraction
from math import comb

import numpy as np
import pytest

from tests.llm.helpers import edge_docs, words
from tierlake.llm import quality


def plain_repeats(text):
    own = words(text)
    windows = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


@pytest.mark.parametrize("text", ["", "a b", "a b c a b c", "a a a a", "x a b c y a b c z", "a b c d a b c d a b", "q w e r t"])
def test_repeat_words(text):
    assert quality.counts(text)[4] == plain_repeats(text)


def test_repeat_words_of_long_texts(monkeypatch):
    texts = ["a b c x a b c", "a a a a a", " ".join(f"w{i % 50}" for i in range(400)), " ".join(f"w{i}" for i in range(99))]
    exact = [quality.counts(t)[4] for t in texts]
    monkeypatch.setattr(quality, "LONG", 3)
    assert [quality.counts(t)[4] for t in texts] == exact == [plain_repeats(t) for t in texts]


def test_counts():
    text = "Ab é#\n\nx|\nx|\n \t\nx|  y\n\n"
    assert quality.counts(text) == (6, 11, 4, 1, 0, 1)
    assert quality.counts(None) == quality.counts("") == (0, 0, 0, 0, 0, 0)


@pytest.mark.parametrize("n, k", [(50, 0), (300, 0), (460, 1), (700, 1), (900, 3), (2000, 10)])
def test_bound_is_exact(n, k):
    p = Fraction(1, 100)
    exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality.binomial_cdf(k, n, 0.01) == pytest.approx(float(exact), rel=1e-9)
    assert quality.holds(k, n, 0.01, 0.01) == (exact <= Fraction(1, 100) and k < n / 100)


def test_sequence_stops_at_the_first_failure():
    args = 1000, 0.01, 0.01
    assert quality.proven([0, 0, 1, 30], *args) == 2
    assert quality.proven([0, 30, 0, 0], *args) == 0
    assert quality.proven([30, 0, 0, 0], *args) == -1
    assert quality.proven([0, 0], *args) == 1
    assert quality.proven([0, 0], 1000, 0.01, 0.0) == -1


def test_most_useful_cutoff():
    assert quality.most_useful([0, 0, 1, 30], [1, 2, 9, 99], 2) == 2
    assert quality.most_useful([0, 0, 1, 1], [3, 5, 5, 5], 3) == 1  # stricter ones catch no more junk
    assert quality.most_useful([0, 1, 2, 2], [0, 1, 2, 2], 3) is None
    assert quality.most_useful([0, 0], [5, 9], -1) is None


@pytest.mark.parametrize("sizes, share", [
    ([1973, 475, 488, 307], 0.05 / 4), ([214, 36, 30, 47], 0.05), ([150, 20], 0.0), ([], 0.0), ([0], 0.0), ([250, 250], 0.025)])
def test_error_is_shared_by_strata_that_can_be_proven(sizes, share):
    assert quality.error_share(sizes, 0.015, 0.05) == share


@pytest.mark.parametrize("sizes", [[250, 1000, 3000], [250], [60, 250, 400, 400, 400], [5000] * 4])
def test_false_rejections_stay_limited(sizes):
    """Over many drawn holdouts: seldom does any stratum get a level that rejects too much.

    The true share of false rejections grows with the level and crosses the limit at one of them.
    """
    draw, risk, runs, wrong, found = np.random.default_rng(1), 0.015, 4000, 0, 0
    true = np.array([0.0005, 0.001, 0.004, 0.01, 0.0151, 0.02, 0.04, 0.1])
    share = quality.error_share(sizes, risk, 0.05)
    for _ in range(runs):
        bad = False
        for good in sizes:
            at = draw.random(good)  # a document is rejected from its own level on
            false = [(at < p).sum() for p in true]
            level = quality.proven(false, good, risk, share)
            bad |= level >= 0 and true[level] > risk
            found += level >= 0
        wrong += bad
    assert wrong <= 0.05 * runs + 3 * (0.05 * 0.95 * runs) ** 0.5
    assert found > 0


def test_limit_is_for_all_rules_together(spark):
    """Two rules that each reject a few good documents, other ones: together they are too many."""
    rows, labels = [], []
    for i in range(2000):
        good = i % 10 != 9
        text = " ".join(f"word{i}x{k}" for k in range(60))
        loud = i % 10 == 0 and i % 200 < 20  # 1 in 90 of the good ones
        signs = i % 10 == 1 and i % 200 < 20
        text = text.upper() if loud or not good else text
        text = text + " " + "#" * 400 if signs or not good else text
        rows.append((i, text, "aa"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    measured = quality.measure(docs)
    def rules(risk):
        row = quality.calibrate(measured, table, risk=risk).first()
        return {name for name in quality.RULES if row[name] is not None}

    assert rules(0.01) == set()
    assert rules(0.02) == {"symbol_share"}  # either one alone would be within this limit
    assert rules(0.05) >= {"symbol_share", "upper_share"}


@pytest.mark.parametrize("sf, strata", [("sf0.01", {"en"}), ("sf0.1", {"de", "en", "es", "fr"})])
def test_cutoffs_of_the_given_tables(spark, sf, strata):
    """At sf0.1 every language has a proven level that catches most of the junk."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    measured = quality.measure(docs)
    found = {r["stratum"]: r["level"] for r in quality.calibrate(measured, labels).collect()}
    assert {s for s, level in found.items() if level is not None} == strata
    judged = quality.judge(measured, quality.calibrate(measured, labels)).join(labels, "doc_id").where("NOT base_failed")
    kept = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    # Rules that catch no junk reject no good documents either.
    assert kept.get((1, False), 0) <= 0.001 * kept[1, True]
    assert kept[0, False] >= (0.85 if sf == "sf0.1" else 0.4) * (kept.get((0, True), 0) + kept[0, False])


def test_cutoffs_are_proven_per_stratum(spark):
    """Loud text is rejected where labels prove that it is junk, and kept where good texts are loud."""
    rows, labels = [], []
    for i in range(3000):
        lang, good = ("aa", "bb")[i // 10 % 2], i % 10 != 9
        text = " ".join(f"word{i}x{k}" for k in range(60))
        rows.append((i, text.upper() if lang == "bb" or not good else text, lang))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    cutoffs = {r["stratum"]: r for r in quality.calibrate(quality.measure(docs), table).collect()}
    assert cutoffs["aa"]["upper_share"] is not None
    assert cutoffs["bb"]["upper_share"] is None


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (None, 1), (6, None), (99, 1)], "doc_id long, quality int")
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == []  # too short, or all repeated
    judged = quality.judge(quality.measure(docs), quality.calibrate(quality.measure(docs), labels))
    assert judged.count() == docs.count()
    none = docs.limit(0)
    assert quality.keep(none, labels.limit(0)).count() == 0


@pytest.mark.parametrize("size, letters", [(3, "ab"), (300, "abc"), (300, "abcdefghijklmnop"), (2, "a"), (0, "a")])
def test_repeated_words_of_long_texts(monkeypatch, size, letters):
    draw = np.random.default_rng(size)
    own = [w.encode() for w in draw.choice(list(letters), size)]
    short = quality.repeat_words(own)
    monkeypatch.setattr(quality, "LONG", 2)
    assert quality.repeat_words(own) == short
