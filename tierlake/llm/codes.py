"""Compression of vectors to codes: integer codebooks per part, assignment pruned by pivots (LAESA)."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4
SAFE = 1 << 24  # squared distances of integers below this fit 64 bits, for up to 8192 components
_SLACK = 4e-6  # what single precision and square roots may be off, as a share of the distances


def whole(vectors):
    """floor(4096 * x) of all components: 64-bit integers, or Python's where those could overflow."""
    vectors = np.asarray(vectors, np.float64)
    if not vectors.size or np.abs(vectors).max() < SAFE / SCALE:
        return np.floor(vectors * SCALE).astype(np.int64)
    made = [math.floor(Fraction(x) * SCALE) for x in vectors.ravel().tolist()]
    return np.array(made, object).reshape(vectors.shape)


def cut(vectors, parts=PARTS):
    """The consecutive parts of some vectors; equal, or the first ones longer by one component."""
    return np.array_split(vectors, parts, axis=1)


def squared(a, b):
    """Exact squared distances of rows of integers."""
    if a.dtype != object and b.dtype == object:
        a = a.astype(object)
    return ((a - b) ** 2).sum(axis=1)


def root(distances):
    """Square roots as doubles; what a double cannot hold is infinite."""
    if distances.dtype != object:
        return np.sqrt(distances.astype(np.float64))
    return np.array([math.sqrt(d) if d < 1 << 1000 else math.inf for d in distances])


def choose_pivots(entries, count=PIVOTS):
    """Numbers of entries that lie far apart: each next one is farthest from those before."""
    chosen, far = [0], squared(entries, entries[:1])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, squared(entries, entries[chosen[-1:]]))
    return entries[chosen]


def pivot_distances(part, pivots):
    """Distance of every row of ``part`` to every pivot, in single precision."""
    with np.errstate(over="ignore"):
        return np.stack([root(squared(part, p[None])) for p in pivots], axis=1).astype(np.float32)


def nearest(part, to_pivots, entries, pivots):
    """``(index, squared distance)`` of the nearest of ``entries`` for each row; ties to the lower index.

    LAESA: a row's and an entry's distances to the same pivot differ by no more than the two lie
    apart. The largest of these differences bounds each distance from below. A row meets the
    entries by growing bound, with exact integer distances, until the bound is above the best.
    """
    entry_pivots = pivot_distances(entries, pivots).astype(np.float64)
    rows = to_pivots.astype(np.float64)
    bound = np.zeros((len(part), len(entries)))
    with np.errstate(invalid="ignore"):
        for p in range(len(pivots)):
            ours, theirs = rows[:, p:p + 1], entry_pivots[None, :, p]
            apart = np.abs(ours - theirs) - _SLACK * (ours + theirs)
            np.maximum(bound, np.where(np.isfinite(apart), apart, 0), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    best = squared(part, entries[order[:, 0]])
    index = order[:, 0].copy()
    reach = root(best) * (1 + 1e-9)
    active = np.arange(len(part))
    for turn in range(1, len(entries)):
        active = active[bound[active, turn] <= reach[active]]
        if not len(active):
            break
        entry = order[active, turn]
        found = squared(part[active], entries[entry])
        closer = (found < best[active]) | ((found == best[active]) & (entry < index[active]))
        better = active[closer.astype(bool)]
        best[better], index[better] = found[closer.astype(bool)], entry[closer.astype(bool)]
        reach[better] = root(best[better]) * (1 + 1e-9)
    return index, best


def _columns(batch):
    return {name: batch.column(i) for i, name in enumerate(batch.schema.names)}


def _matrix(column, width):
    """Rows of a list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _with_pivots(pivots, width):
    """Adds ``to_pivots``: the distances of every part to the pivots of its position."""
    def run(batches):
        for batch in batches:
            given = _columns(batch)
            made = [pivot_distances(part, own) for part, own in zip(cut(whole(_matrix(given["vector"], width))), pivots)]
            flat = np.concatenate(made, axis=1)
            offsets = pa.array(np.arange(0, flat.size + 1, flat.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*given.values(), pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))],
                names=[*given, "to_pivots"])

    return run


def _assigned(batch, books, pivots, width):
    """For each part position: the part's integers, the index and the squared distance of each row."""
    given = _columns(batch)
    parts = cut(whole(_matrix(given["vector"], width)))
    count = len(pivots[0])
    to_pivots = _matrix(given["to_pivots"], count * len(parts))
    for at, part in enumerate(parts):
        index, best = nearest(part, to_pivots[:, at * count:(at + 1) * count], books[at], pivots[at])
        yield part, index, best


def _sums(books, pivots, width):
    """A task's sums: rows ``(part, entry, n, sums)``, one for each entry in use."""
    def run(batches):
        counts, sums = {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for at, (part, index, _) in enumerate(_assigned(batch, books, pivots, width)):
                for entry in np.unique(index).tolist():
                    own = part[index == entry]
                    counts[at, entry] = counts.get((at, entry), 0) + len(own)
                    total = sums.setdefault((at, entry), [0] * part.shape[1])
                    sums[at, entry] = [a + int(b) for a, b in zip(total, own.sum(axis=0))]
        keys = sorted(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([counts[k] for k in keys], pa.int64()),
            # As text, since sums of large components fit no numeric type.
            pa.array([[str(x) for x in sums[k]] for k in keys], pa.list_(pa.string())),
        ], names=["part", "entry", "n", "sums"])

    return run


def _total(rows):
    """The tasks' sums of one entry added up."""
    sums = [sum(map(int, own)) for own in zip(*rows["sums"])]
    return pd.DataFrame({
        "part": rows["part"][:1], "entry": rows["entry"][:1], "n": [rows["n"].sum()],
        "sums": [[str(x) for x in sums]]})


def _codes(books, pivots, width):
    def run(batches):
        for batch in batches:
            given = _columns(batch)
            found = list(_assigned(batch, books, pivots, width)) if batch.num_rows else []
            codes = ["".join(f"{i:02x}" for i in row) for row in zip(*[index.tolist() for _, index, _ in found])]
            errors = [sum(map(int, row)) for row in zip(*[best.tolist() for _, _, best in found])]
            yield pa.RecordBatch.from_arrays(
                [given["id"], given["label"], pa.array(codes, pa.string()),
                 pa.array([str(e) for e in errors], pa.string())],
                names=["id", "label", "code", "error"])

    return run


def usable(vectors, id_column, vector_column, label_column):
    """``(id, label, vector)`` of the rows that can be coded, and the vectors' common length.

    Null vectors and those with null or non-finite components are dropped, and so are vectors of
    another length than the one with the smallest id among the rest, which cannot be cut alike.
    """
    given = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    given = given.where(F.forall(
        F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & (F.size("vector") > 0))
    first = given.orderBy(F.asc_nulls_last("id"), "vector").select(F.size("vector")).first()
    width = first[0] if first else 0
    return given.where(F.size("vector") == width), width


def compress(vectors, id_column="vec_id", vector_column="embedding", label_column="label",
             entries=ENTRIES, rounds=ROUNDS, pivots=PIVOTS):
    """Codes of all vectors, their errors, and a digest of the codebooks.

    Returns ``(id, code, error, label_error, codebooks_sha256)``. Components become
    floor(4096 x), vectors are cut into 8 parts (of equal length where 8 divides it), and each
    position has a codebook that starts as that part of the ``entries`` smallest ids (then by
    vector; null ids come last; fewer rows make a smaller codebook). A round assigns every part
    to the nearest entry, ties to the lower index, and then makes each entry the floor of its
    parts' mean; entries without parts stay. ``code`` has two hex digits per position,
    ``error`` is the sum of squared distances, ``label_error`` that of all rows of the label
    (nulls together). Either is null if it does not fit a long. See :func:`usable` for the rows
    that are dropped; repeated rows are coded each.

    Integers are exact at any size. The pivots are some entries of the first codebooks and stay
    the same, so each part meets them once; the distances are staged beside the vectors. A
    round's sums are added up in the tasks, then by entry; only the codebooks, 16 entries for
    each position, pass through the driver.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    given, width = usable(vectors, id_column, vector_column, label_column)
    shape = (f"{id_column} {_kind(vectors, id_column)}, code string, error long, label_error long, "
             "codebooks_sha256 string")
    if not width:
        return spark.createDataFrame([], shape)
    seeds = given.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    books = cut(whole([row["vector"] for row in seeds]))
    fixed = [choose_pivots(book, pivots) for book in books]
    near = scratch.write(given.mapInArrow(
        _with_pivots(fixed, width),
        f"id {_kind(given, 'id')}, label {_kind(given, 'label')}, vector {_kind(given, 'vector')}, "
        "to_pivots array<float>"), "pivots")
    sums = "part int, entry int, n long, sums array<string>"
    for _ in range(rounds):
        partial = near.select("vector", "to_pivots").mapInArrow(_sums(books, fixed, width), sums)
        total = partial.groupBy("part", "entry").applyInPandas(_total, sums)
        # Bounded: 8 codebooks of 16 entries, whatever the number of vectors.
        rows = total.collect()
        books = [_moved(book, [row for row in rows if row["part"] == at]) for at, book in enumerate(books)]
    flat = ",".join(str(x) for book in books for entry in book for x in entry.tolist())
    digest = hashlib.sha256(flat.encode()).hexdigest()
    coded = near.select("id", "label", "vector", "to_pivots").mapInArrow(
        _codes(books, fixed, width),
        f"id {_kind(given, 'id')}, label {_kind(given, 'label')}, code string, error string")
    # Sums of longs: a decimal of 38 digits holds those of 10^19 rows.
    coded = scratch.write(coded.withColumn("error", F.col("error").try_cast("bigint")), "codes")
    scratch.drop("pivots")
    # Staged, so that Spark knows the size: small tables of labels are broadcast, and else
    # adaptive execution splits a label with most of the rows.
    by_label = scratch.write(coded.groupBy("label").agg(
        F.when(F.count_if(F.col("error").isNull()) == 0, F.sum(F.col("error").cast("decimal(38,0)")))
        .try_cast("bigint").alias("label_error")), "labels").withColumnRenamed("label", "own")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("own"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _kind(df, column):
    return df.schema[column].dataType.simpleString()


def _moved(book, rows):
    """The codebook with each entry in use at the floor of its parts' mean."""
    moved = [entry.tolist() for entry in book]
    for row in rows:
        moved[row["entry"]] = [int(x) // row["n"] for x in row["sums"]]
    large = any(abs(x) >= SAFE for entry in moved for x in entry)
    return np.array(moved, object if large else np.int64)
