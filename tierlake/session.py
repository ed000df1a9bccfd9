"""Session options, scratch space and shuffle sizing."""

import math
import tempfile
import uuid
from contextlib import contextmanager

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
MAX_PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def configure(spark):
    """Set the options that results or plans depend on; returns the session.

    Dates are UTC dates, and adaptive execution is what coalesces, balances and
    splits the shuffles of the layer writes.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def use_local_scratch(spark):
    """Give a local session that names no shared folder one of its own; returns the session."""
    local = spark.conf.get("spark.master").startswith("local") and "cluster" not in spark.conf.get("spark.master")
    if local and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tierlake-"))
    return spark


def scratch_dir(spark, label="scratch"):
    """A new folder name under the shared folder that ``spark.checkpoint.dir`` names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("spark.checkpoint.dir has to name a folder all executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark, key, value):
    """Context in which the session option ``key`` is ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_sized_for(spark, rows, rows_per_partition=1_000_000, most=100_000):
    """Context that widens shuffles to ``rows / rows_per_partition`` partitions.

    A window or a rebalance cannot split a shuffle partition that turned out too
    large for memory, but adaptive execution merges those that are too small.
    So the width follows the row count and is never lowered; beyond ``most``
    partitions they grow instead, and their sorts spill.
    """
    current = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get(SHUFFLE_PARTITIONS)
    wanted = min(math.ceil(rows / rows_per_partition), most)
    return setting(spark, INITIAL_PARTITIONS, str(max(int(current), wanted)))


def skimming_scans(spark, bytes_per_task=16 << 30):
    """Context for actions that only look at listings, file footers or page counts.

    Spark cuts files into tasks by their size, even if next to nothing is read.
    Larger cuts keep such an action over many terabytes at a few thousand tasks;
    small inputs are still spread over all cores.
    """
    return setting(spark, MAX_PARTITION_BYTES, str(bytes_per_task))


def bounded_listings(spark, most=100):
    """Context in which Spark lists folders in at most ``most`` tasks at a time.

    With many folders it takes a task for each, up to 10,000, and each sends some 3 kB to the
    driver besides the files it found. A task that lists several sends that once.
    """
    return setting(spark, LISTING_TASKS, str(min(int(spark.conf.get(LISTING_TASKS)), most)))
