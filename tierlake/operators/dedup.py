from pyspark.sql import Window
from pyspark.sql import functions as F


def latest_per_key(df, key, order_by, null_key="collapse", types=None):
    """The first row per ``key``, by ``order_by`` descending with nulls last.

    ``types`` names the type by which a column is ordered, as in ``{"version": "bigint"}``: text
    that is none comes last, and equal values go by their text. Without it a column goes by the
    type it has, so versions kept as text put ``9`` above ``10``.

    Ties are broken by all remaining columns, so the same input always gives the
    same row. Spark keeps one row per key and task before it shuffles (group
    limit), so a key that holds most of the rows arrives as one row per task.

    ``null_key="collapse"`` treats null as one key like any other; with ``"keep"`` every row
    without a key is one of its own, and such rows are spread over all tasks.
    """
    if null_key not in ("collapse", "keep"):
        raise ValueError(f"null_key must be 'collapse' or 'keep', not {null_key!r}")
    types = types or {}
    unknown = set(types) - set(order_by)
    if unknown:
        raise ValueError(f"types are for columns of order_by, not {sorted(unknown)}")
    rest = [c for c in df.columns if c != key and c not in order_by]
    own, rank = unused_names(df, "own", "rank")
    keys = [F.col(key)]
    if null_key == "keep":
        df = df.withColumn(own, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
        keys.append(F.col(own))
    order = []
    for c in [*order_by, *rest]:
        if c in types:
            order.append(F.col(c).try_cast(types[c]).desc_nulls_last())
        order.append(F.col(c).desc_nulls_last())
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(newest_first))
    return ranked.where(F.col(rank) == 1).drop(rank, own)


def unused_names(df, *names):
    """Names made from ``names`` that no column of ``df`` has, in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while f"_{name}".lower() in taken:
            name = f"_{name}"
        found.append(f"_{name}")
    return found
