"""Connected components by alternating stars."""

from pyspark.sql import functions as F


def components(edges, scratch, label="edges"):
    """``(node, component)`` for every node of ``edges`` (columns ``a``, ``b``, two longs).

    ``component`` is the smallest node that can be reached. Every round joins each
    neighbour to the smallest node it can see (large star, then small star), so a chain
    of n nodes needs about log n rounds. A round is staged in the shared folder; only a
    count and a checksum reach the driver.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = scratch.write(edges, f"{label}0")
    seen, turn = None, 0
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen, turn = now, turn + 1
        larger = scratch.write(_large_star(edges, scratch, label), f"{label}-larger")
        edges = scratch.write(_small_star(larger, scratch, label), f"{label}{turn}")
        scratch.drop(f"{label}{turn - 1}", f"{label}-least", f"{label}-larger", f"{label}-smallest")
    # In the end all edges are (node, root).
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _large_star(edges, scratch, label):
    """Edges ``a > b``: the larger neighbours of each node go to the smallest one near it.

    The smallest ones are staged, so that adaptive execution can split a node with very many
    neighbours in the join.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = scratch.write(least, f"{label}-least")
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges, scratch, label):
    """Edges ``a > b``: a node and its smaller neighbours go to the smallest of them (staged, too)."""
    least = scratch.write(edges.groupBy("a").agg(F.min("b").alias("m")), f"{label}-smallest")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
