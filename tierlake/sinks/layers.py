"""Writing snapshots: one date is replaced as a whole, other dates are not touched."""

from tierlake.layout import snapshot_path
from tierlake.schemas import LOCATION_COLUMNS
from tierlake.sinks.publish import publish, staged

#: Formats whose own commit replaces a table in one step.
TRANSACTIONAL = ("delta",)


def write_snapshot(df, root, date, partition_by=(), fmt="parquet", **options):
    """Replace the snapshot ``date`` of a layer by ``df``, in one step.

    Rows are first rebalanced on the partition columns: a partition gets few
    files, and one that holds much of the data is split over several tasks.
    The snapshot is written in full beside the others and then put in its place, so readers
    find the former one until then, and a run that fails leaves it as it was.
    ``options`` go to the writer. ``df`` may read the snapshot that it replaces.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)

    def write(folder):
        writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
        writer.options(**options).partitionBy(*partition_by).save(folder)

    target = snapshot_path(root, date)
    if fmt in TRANSACTIONAL:
        write(target)
        return
    with staged(df.sparkSession, root) as folder:
        write(folder)
        publish(df.sparkSession, folder, root, date)


def write_silver(df, layout, date):
    write_snapshot(df, layout.silver, date, LOCATION_COLUMNS)


def write_gold(df, layout, date, fmt="parquet"):
    write_snapshot(df, layout.gold, date, LOCATION_COLUMNS, fmt)
