"""Session settings, staged tables and small helpers that the operators share."""

from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.session import scratch_dir, use_local_scratch

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Texts can be long: bound what one Arrow batch holds by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # A finished write no longer needs its shuffle files.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark):
    """Set the options the operators rely on.

    Staged tables go to the folder in ``spark.checkpoint.dir``; only a local session
    that names none gets one of its own.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return use_local_scratch(spark)


_staging = []  # paths staged in each open block of :func:`staging`


@contextmanager
def staging(spark):
    """Block at whose end all tables that operators staged in it are deleted.

    Results are lazy and read those tables, so they have to be written within the block.
    """
    paths = []
    _staging.append(paths)
    try:
        yield
    finally:
        _staging[:] = [own for own in _staging if own is not paths]
        for path in paths:
            _delete(spark, path)


def _delete(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables of one run in the shared folder: they cut lineage and survive lost executors.

    Those of a ``lasting`` one outlive a block of :func:`staging`.
    """

    def __init__(self, spark, lasting=False):
        self.spark, self.lasting = spark, lasting
        self.paths = {}

    def write(self, df, label):
        """``df`` as written and read back; ``label`` names it for :meth:`drop`."""
        path = scratch_dir(self.spark, label.replace(" ", "-"))
        if _staging and not self.lasting:
            _staging[-1].append(path)
        df.write.option("compression", "zstd").parquet(path)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels):
        """Delete tables that no later step reads."""
        for label in labels:
            _delete(self.spark, self.paths.pop(label))


def hash_sample(df, column, rows):
    """The rows of ``df`` with the smallest hashes of ``column``: about ``rows`` of them, or all.

    The same rows at every run; equal values are in or out together. Nothing is sorted
    and only the row count reaches the driver.
    """
    share = rows / max(df.count(), 1)
    if share >= 1:
        return df
    return df.where(F.xxhash64(column) < -(1 << 63) + int(share * (1 << 64)))


def read(spark, sf_dir, table, *columns):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def without(df, *names):
    """``df`` without columns called like one of ``names``, in any case."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def shielded(df, *given):
    """``df`` with columns named ``c0``, ``c1``, ..., and the new names of the columns ``given``.

    No operator has such names of its own, so those of the caller clash with none.
    """
    lower = [name.lower() for name in df.columns]
    return df.toDF(*[f"c{i}" for i in range(len(lower))]), *[f"c{lower.index(name.lower())}" for name in given]


def restored(df, columns):
    """The columns of a shielded frame under their names, ``columns``; others are dropped."""
    return df.select(*[f"c{i}" for i in range(len(columns))]).toDF(*columns)


def schema_with(df, **columns):
    """The schema of ``df`` and further columns, given as ``name="type"``."""
    added = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in columns.items()]
    return T.StructType([*df.schema.fields, *added])
