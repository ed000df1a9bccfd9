"""Mixing sources to target weights by Poisson replication."""

from pyspark.sql import functions as F

from tierlake.llm.common import Scratch, restored, shielded, without

ADDED = ("copy", "rate", "order_key")
LAMBDA_MOST = 32.0  # mean that one inverted distribution may have; larger rates are split


def uniform(seed, *columns):
    """A number in (0, 1) by the md5 of ``seed`` and the columns as text; null counts as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def rates(docs, targets, size, source_column="source", total=None):
    """``(source, size, rate)``: mean number of copies of each source's documents.

    ``targets`` has ``source, weight`` (weights need not sum to 1). ``size`` is the column of
    a document's size. The mixture is to have ``total`` (by default the size of all
    documents with a target). Sources without a target, or with a null or negative
    weight, get rate 0; a null source is a source of its own. Sizes that are null or
    negative count as 0, and a source of size 0 gets rate 0.
    """
    sizes = docs.groupBy(F.col(source_column).alias("source")).agg(
        F.sum(F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))).alias("size"))
    weights = targets.groupBy(F.col("source").alias("_source")).agg(
        F.sum(F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)))
        .alias("weight"))
    known = sizes.join(weights, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    present = known.where("weight > 0 AND size > 0")
    sums = present.agg(
        F.sum("weight").alias("_weights"),
        (F.sum("size") if total is None else F.lit(total)).cast("double").alias("_total"))
    # One row joins each source's row.
    rate = F.when((F.col("weight") > 0) & (F.col("size") > 0),
                  F.col("weight") / F.col("_weights") * F.col("_total") / F.col("size"))
    return known.join(F.broadcast(sums), F.lit(True)).select(
        "source", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson(rate, seed, key):
    """Poisson number of mean ``rate`` by inverting its distribution at a uniform hash of ``key``.

    A rate above ``LAMBDA_MOST`` is the sum of equal, independently seeded parts, so that
    no probability underflows.
    """
    parts = F.greatest(F.ceil(rate / LAMBDA_MOST), F.lit(1)).cast("int")
    mean = rate / parts

    def one(part):
        digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), part.cast("string"), key)), 1, 12)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
        # Steps to where the rest of the distribution is below the grain of u.
        steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int"))
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("n"))

        def step(state, k):
            p = state["p"] * mean / k
            return F.struct(
                p.alias("p"), (state["cdf"] + p).alias("cdf"),
                F.when(state["cdf"] <= u, k).otherwise(state["n"]).alias("n"))

        return F.aggregate(steps, start, step, lambda state: state["n"])

    counts = F.transform(F.sequence(F.lit(1), parts), one)
    return F.when(rate > 0, F.aggregate(counts, F.lit(0), lambda a, b: a + b)).otherwise(F.lit(0))


def mix(docs, targets, size, id_column="doc_id", source_column="source", seed=17, total=None):
    """``docs`` with each document repeated by its Poisson count, in a global random order.

    Adds ``copy`` (1, 2, ...), ``rate`` and ``order_key``, a uniform hash of the id and the
    copy. Every row goes to a task that the key names, and is sorted by the key there; that is
    a random order of all rows, without the sampling pass of a range sort. Input columns of these names give way.
    Counts depend on id, source and seed alone, so a lost task makes the same rows again;
    rows that repeat an id get the same count. A null id counts as one id. An empty
    table stays empty.

    The rates are one row per source. They are staged, so that Spark knows their size: it
    broadcasts them if small, and else joins in a way that adaptive execution splits at a hot
    source.
    """
    docs = without(docs, *ADDED)
    given, size, id_column, source_column = shielded(docs, size, id_column, source_column)
    mixed = _mix(given, targets, size, id_column, source_column, seed, total)
    names = [f"c{i}" for i in range(len(docs.columns))]
    return mixed.select(*names, *ADDED).toDF(*docs.columns, *ADDED)


def repeat(docs, targets, size, id_column="doc_id", source_column="source", seed=17, total=None):
    """:func:`mix` with the columns of ``docs`` alone, of whatever names."""
    given, size, id_column, source_column = shielded(docs, size, id_column, source_column)
    return restored(_mix(given, targets, size, id_column, source_column, seed, total), docs.columns)


def _mix(docs, targets, size, id_column, source_column, seed, total):
    by_source = Scratch(docs.sparkSession).write(
        rates(docs, targets, size, source_column, total).select(F.col("source").alias("_source"), "rate"),
        "rates")
    joined = docs.join(
        by_source, F.col(source_column).eqNullSafe(F.col("_source"))).drop("_source")
    key = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    copies = joined.withColumn("_copies", poisson(F.col("rate"), seed, key)).where("_copies > 0")
    exploded = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")
    shuffled = exploded.withColumn("order_key", uniform(f"{seed}/order", id_column, "copy"))
    return shuffled.repartition("order_key").sortWithinPartitions("order_key", id_column, "copy")
