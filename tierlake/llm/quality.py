"""Quality rules whose cutoffs come from labelled holdouts with exact binomial bounds."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch, restored, schema_with, shielded, without
from tierlake.llm.words import SPACES, words
from tierlake.operators.dedup import unused_names

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]
#: name -> what a document is rejected for exceeding, from the columns of COUNTS
RULES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
}
#: Cutoffs of each rule by level, lenient to strict.
CUTOFFS = {
    "symbol_share": [0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01],
    "upper_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1],
    "repeat_share": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05],
    "dup_line_share": [0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.015, 0.01],
    "word_length": [40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 11.0, 10.0, 9.0],
}
#: The rules together may falsely reject this share of the good documents of a stratum ...
RISK = 0.015
#: ... unless something happens whose probability is below this, over all strata.
DELTA = 0.05
MIN_WORDS = 50
LONG = 200_000  # words
REPEAT_PERCENT = 50


def counts(text):
    """The numbers of ``COUNTS`` for one whole text; null and empty texts have zeros."""
    text = text or ""
    own = words(text)
    if not own:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0
    chars = len(text) - sum(map(text.count, SPACES))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(SPACES):
            seen.add(line)
    raw = text.encode("utf-8", "surrogatepass")
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = sum(map(text.count, SYMBOLS))
    return len(own), chars, symbols, repeated, repeat_words(own), upper


def repeat_words(own):
    """Words that lie in a window of three that occurs at least twice in the text.

    Of very long texts the distinct words and pairs of words are numbered, which takes a small
    part of the memory and counts the same.
    """
    if len(own) > LONG:
        numbers = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own))
        _, pairs = np.unique(ids[:-2] << 32 | ids[1:-1], return_inverse=True)
        _, code, times = np.unique(pairs << 32 | ids[2:], return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[code] > 1)
        covered = np.zeros(len(own), bool)
        for shift in range(3):
            covered[at + shift] = True
        return int(covered.sum())
    windows = list(zip(own, own[1:], own[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first, covered = {}, bytearray(len(own))
    for at, window in enumerate(windows):
        earlier = first.setdefault(window, at)
        if earlier != at:
            covered[at:at + 3] = covered[earlier:earlier + 3] = b"\1\1\1"
    return sum(covered)


def measure(docs, text_column="text"):
    """``docs`` with the columns of ``COUNTS`` and ``base_failed``; columns of these names give way."""
    docs = without(docs, *COUNTS, "base_failed")
    texts = docs.columns.index(text_column)
    fields = [pa.field(name, pa.int64()) for name in COUNTS]

    def run(batches):
        for batch in batches:
            made = list(zip(*map(counts, batch.column(texts).to_pylist()))) or [[]] * len(COUNTS)
            arrays = [*batch.columns, *[pa.array(c, pa.int64()) for c in made]]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([*batch.schema, *fields]))

    given = schema_with(docs, **{name: "long" for name in COUNTS})
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return docs.mapInArrow(run, given).withColumn("base_failed", failed)


def binomial_cdf(k, n, p):
    """P(X <= k) for X binomial with n trials of probability p."""
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)
    ]
    most = max(logs)
    return min(1.0, math.exp(most) * sum(math.exp(x - most) for x in logs))


def holds(false, good, risk, level):
    """Whether the exact (Clopper-Pearson) upper bound of false/good at ``level`` is at most ``risk``."""
    if good == 0 or false >= risk * good:
        return False
    return binomial_cdf(false, good, risk) <= level


def calibrate(measured, labels, stratum="lang", id_column="doc_id", risk=RISK, delta=DELTA,
              cutoffs=CUTOFFS):
    """Cutoffs per stratum: ``stratum, good, level`` and one nullable double column per rule.

    ``measured`` is the output of :func:`measure`, of which the rows with a label serve as
    the holdout; ``labels`` has the id and ``quality`` (1 good, 0 junk). A document with several
    labels is good if all of them say so; null ids and labels are ignored.

    Level t has every rule at its t-th cutoff, and what counts is whether any of them rejects a
    document: so the limit holds for all rules together. In a stratum the levels are tested in
    order, lenient to strict, up to the first failure, which needs no correction. The strata
    are corrected for by Tarone's form of Bonferroni (:func:`error_share`). ``level`` is the last
    one proven, null if there is none. Rules that stay on its lenient side, or out, reject no
    more documents than it does; so each rule takes, of its cutoffs up to that level, the one
    that rejects most labelled junk beyond the good documents it rejects. Equal ones go to the
    lenient side, and a rule without such a cutoff rejects nothing (null).

    Rejections are counted for all labelled documents in one aggregation; the tests
    run on the small table of counts, in tasks.
    """
    labelled = labels.where(f"{id_column} IS NOT NULL AND quality IS NOT NULL").groupBy(id_column).agg(
        (F.min("quality") == 1).alias("_good"))
    rows = measured.where("NOT base_failed").select(
        id_column, F.col(stratum).cast("string").alias("stratum"),
        *[F.expr(rule).alias(name) for name, rule in RULES.items()])
    held = rows.join(labelled, id_column)
    levels = range(min(len(cutoffs[name]) for name in RULES))

    def rejected(good, *rules):
        return F.array(*[
            F.count_if(F.greatest(*[F.col(name) > cutoffs[name][level] for name in [*rules, rules[0]]])
                       & (F.col("_good") == good)) for level in levels])

    tallies = held.groupBy("stratum").agg(
        F.count_if("_good").alias("good"), rejected(True, *RULES).alias("false"),
        *[F.struct(rejected(True, name).alias("false"), rejected(False, name).alias("junk")).alias(name) for name in RULES])
    # One number per stratum.
    sizes = tallies.agg(F.collect_list("good").alias("sizes"))
    tallies = tallies.join(F.broadcast(sizes), F.lit(True))

    def choose(batches):
        for table in batches:
            found = [
                proven(false, good, risk, error_share(sizes, risk, delta))
                for false, good, sizes in zip(table["false"], table["good"], table["sizes"])]
            made = table[["stratum", "good"]].copy()
            made["level"] = pd.array([level if level >= 0 else None for level in found], "Int32")
            for name in RULES:
                best = [most_useful(counts["false"], counts["junk"], level) for counts, level in zip(table[name], found)]
                made[name] = [math.nan if at is None else cutoffs[name][at] for at in best]
            yield made

    schema = "stratum string, good long, level int, " + ", ".join(f"{name} double" for name in RULES)
    found = tallies.mapInPandas(choose, schema)
    return found.select("stratum", "good", "level", *[F.nanvl(name, F.lit(None)).alias(name) for name in RULES])


def error_share(sizes, risk, delta):
    """What each stratum may use of the error probability ``delta``; 0 if none can be proven.

    ``sizes`` are the strata's numbers of good documents. Only strata so large that a level
    without a single false rejection would be proven can err at all, so ``delta`` is divided
    by their number alone, the largest that is in keeping with itself. The outcome of no test
    has a part in it.
    """
    able = [k for k, n in enumerate(sorted(map(int, sizes), reverse=True), start=1) if (1 - risk) ** n <= delta / k]
    return delta / max(able) if able else 0.0


def proven(false, good, risk, share):
    """The last level before the first that cannot be proven; none: -1."""
    for level, k in enumerate(map(int, false)):
        if not holds(k, int(good), risk, share):
            return level - 1
    return len(false) - 1


def most_useful(false, junk, last):
    """Of a rule's cutoffs up to level ``last``, the one with most junk beyond good; none: None."""
    best, most = None, 0
    for level in range(last + 1):
        if int(junk[level]) - int(false[level]) > most:
            best, most = level, int(junk[level]) - int(false[level])
    return best


def judge(measured, cutoffs, stratum="lang"):
    """``measured`` with ``kept``: not failed by the base and no rule above its stratum's cutoff.

    A stratum without cutoffs is judged by the base alone. Cutoffs are one row per
    stratum, joined under Spark's own size check. A column ``kept`` gives way.
    """
    own, *names = unused_names(measured, "stratum", *RULES)
    limits = cutoffs.select(
        F.col("stratum").alias(own), *[F.col(rule).alias(name) for rule, name in zip(RULES, names)])
    above = [F.coalesce(F.expr(rule) > F.col(name), F.lit(False)) for name, rule in zip(names, RULES.values())]
    rejected = F.col("base_failed")
    for rule in above:
        rejected = rejected | rule
    joined = without(measured, "kept").join(
        limits, F.col(stratum).cast("string").eqNullSafe(F.col(own)), "left")
    return joined.withColumn("kept", ~rejected).drop(*limits.columns)


def keep(docs, labels, stratum="lang", id_column="doc_id", text_column="text"):
    """``docs`` without the rejected ones; columns and repeated rows stay as they are.

    A first pass measures every document, and its narrow rows meet the labels; a second one
    measures again and judges every document where it lies. So no text is shuffled.
    """
    scratch = Scratch(docs.sparkSession)
    narrow = measure(docs.select(id_column, text_column, stratum), text_column).drop(text_column)
    measured = scratch.write(narrow, "measured")
    cutoffs = scratch.write(calibrate(measured, labels, stratum, id_column), "cutoffs")
    scratch.drop("measured")
    given, text, own = shielded(docs, text_column, stratum)
    return restored(judge(measure(given, text), cutoffs, own).where("kept"), docs.columns)
