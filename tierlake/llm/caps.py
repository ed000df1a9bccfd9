"""Near-duplicate vectors by spherical-cap filters from a random product code."""

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import Scratch
from tierlake.llm.components import components

THRESHOLD = 0.95
PARTS = 3
FILTERS = 12  # caps of one code that a vector is to lie in, on average
LEAST = 8  # caps of one code for every vector; where the threshold gives fewer, the nearest ones
MISS = 1e-4  # probability that two vectors just at the threshold share no cap of any code
TRIALS = 2000  # pairs drawn to see how often one code misses a pair
MOST_CODES = 256
BUCKET = 48  # vectors that a cap is to hold, on average
BLOCK = 1024  # vectors compared with as many others in one step


def code_size(vectors):
    """Codewords per part, so that caps hold about ``BUCKET`` vectors however many there are."""
    return max(4, math.ceil((vectors * FILTERS / BUCKET) ** (1 / PARTS)))


@lru_cache(maxsize=256)
def codebooks(dimension, words, code):
    """A random rotation, and random unit codewords of each part of a rotated vector.

    A filter is one codeword of each part. The rotation makes every two vectors meet as
    random ones of their cosine do, whichever components hold their length. A part's
    codewords have the length of its share of the dimensions, so that every filter is a
    unit vector. Parts without a dimension have one codeword, 0.
    """
    draw = np.random.Generator(np.random.PCG64([97, code]))
    rotation, upper = np.linalg.qr(draw.standard_normal((dimension, dimension)))
    rotation *= np.sign(np.diag(upper))  # else not all rotations are equally likely
    books = []
    for part in np.array_split(np.arange(dimension), PARTS):
        if len(part) == 0:
            books.append(np.zeros((1, 0)))
            continue
        book = draw.standard_normal((words, len(part)))
        book *= math.sqrt(len(part) / dimension) / np.linalg.norm(book, axis=1, keepdims=True)
        books.append(book)
    return rotation, books


def _of_code(unit, words, code):
    """Numbers of the filters of one code whose product with a unit vector reaches the threshold.

    List decoding: the products of each part are sorted, and a codeword of one part is joined
    only to those of the next that can still reach the threshold with the best of the last; so
    filters out of reach are never looked at.
    """
    rotation, books = codebooks(len(unit), words, code)
    split = np.array_split(rotation @ unit, PARTS)
    first, second, third = (book @ part for book, part in zip(books, split))
    one, two = np.argsort(-first), np.argsort(-second)
    rising, best = -second[two], third.max()
    count = len(first) * len(second) * len(third)
    share = min(FILTERS / count, 0.5)
    alpha = NormalDist().inv_cdf(1 - share) / math.sqrt(len(unit))
    order = np.argsort(-third)
    falling = -third[order]
    want = min(LEAST, count)
    while True:
        partners = np.searchsorted(rising, first[one] + best - alpha + 1e-9, "right")
        rows = np.repeat(np.arange(len(one)), partners)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(partners) - partners, partners)
        near = one[rows] * len(second) + two[places]
        reach = np.searchsorted(falling, first[one[rows]] + second[two[places]] - alpha, "right")
        if reach.sum() >= want:
            break
        alpha -= 0.25 / math.sqrt(len(unit))
    pair = np.repeat(near, reach)
    rank = np.arange(len(pair)) - np.repeat(np.cumsum(reach) - reach, reach)
    return code * count + pair * len(third) + order[rank]


def caps(unit, words, codes):
    """Numbers of the filters of all codes that a unit vector lies in, sorted."""
    return np.sort(np.concatenate([_of_code(unit, words, code) for code in range(codes)]))


@lru_cache(maxsize=64)
def codes_needed(dimension, words, threshold):
    """Independent codes of which all miss a pair at ``threshold`` with probability ``MISS`` at most.

    One code's share of missed pairs is measured on random pairs, which after the rotation
    stand for all pairs, and is taken at its upper bound. It grows with the code, so the
    number of codes follows the table.
    """
    if dimension < 2:
        return 1
    draw, missed = np.random.Generator(np.random.PCG64(98)), 0
    for _ in range(TRIALS):
        a, b = np.linalg.qr(draw.standard_normal((dimension, 2)))[0].T
        b = threshold * a + math.sqrt(max(1 - threshold**2, 0)) * b
        missed += not np.isin(_of_code(a, words, 0), _of_code(b, words, 0)).any()
    share = (missed + 2 * math.sqrt(missed) + 3) / TRIALS
    codes = math.ceil(math.log(MISS) / math.log(share)) if share < 1 else MOST_CODES + 1
    if codes > MOST_CODES:
        raise ValueError(f"threshold {threshold} is too low for caps")
    return codes


def _decode(words, threshold):
    def run(batches):
        for batch in batches:
            found = []
            for values in batch.column(1).to_pylist():
                vector = np.array(values, np.float64)
                scale = np.abs(vector).max()
                vector = vector / scale
                codes = codes_needed(len(vector), words, threshold)
                found.append(caps(vector / np.linalg.norm(vector), words, codes))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "caps"])

    return run


def _linked(threshold, kind):
    """``(uid, links, root)`` of the vectors linked within each group of the sorted rows.

    A group is two blocks of one cap, or one block with itself; it has at most two blocks
    of rows. A pair counts only in the smallest cap that it shares.
    """

    def group(cap, own, rows):
        uids, sides, sizes, vectors, lists = rows
        values = np.array(vectors, np.float64)
        values /= np.abs(values).max(1, keepdims=True)
        norms = np.linalg.norm(values, axis=1)
        near = (values @ values.T) / norms[:, None] / norms[None, :] >= threshold
        near &= np.triu(np.ones_like(near), 1)
        if not own:
            near &= sides[:, None] != sides[None, :]
        if not near.any():
            return None
        # Caps before this one that at least two rows share.
        flat, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        before = flat < cap
        names, code, times = np.unique(flat[before], return_inverse=True, return_counts=True)
        if (times > 1).any():
            column = np.cumsum(times > 1) - 1
            shared = (times > 1)[code]
            member = np.zeros((len(uids), int((times > 1).sum())), np.float32)
            member[owner[before][shared], column[code[shared]]] = 1
            near &= member @ member.T == 0
        near |= near.T
        links = near @ sizes
        at = np.flatnonzero(links)
        near, root = near[np.ix_(at, at)], np.arange(len(at))
        while True:
            lower = np.minimum(root, np.where(near, root[None, :], len(at)).min(1)) if len(at) else root
            if (lower == root).all():
                break
            root = lower
        return uids[at], links[at], uids[at][root]

    def run(batches):
        held, parts = None, []

        def flush():
            if not parts:
                return
            uids, sides, sizes, vectors, lists = (sum((list(p[i]) for p in parts), []) for i in range(5))
            if len(uids) > 1:
                made = group(held[1], held[2] == held[3], (
                    np.array(uids), np.array(sides), np.array(sizes, np.int64), vectors, lists))
                if made is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["uid", "links", "root"])

        for batch in batches:
            length, cap, low, high, uid, side, size, vector, lists = batch.columns
            keys = np.column_stack([c.to_numpy().astype(np.int64) for c in (length, cap, low, high)])
            breaks = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            edges = [0, *breaks.tolist(), len(keys)]
            vectors = [np.frombuffer(v.as_buffer(), kind) for v in vector]
            capped = [np.frombuffer(v.as_buffer(), np.int64) for v in lists]
            uids, sides, sizes = uid.to_numpy(), side.to_numpy(), size.to_numpy()
            for start, stop in zip(edges, edges[1:]):
                key = tuple(keys[start].tolist())
                if key != held:
                    yield from flush()
                    held, parts = key, []
                parts.append((uids[start:stop], sides[start:stop], sizes[start:stop],
                              vectors[start:stop], capped[start:stop]))
        yield from flush()

    return run


def _packed(words, threshold, kind):
    """As :func:`_decode`, with the vector and its caps as binaries of numbers."""
    decode = _decode(words, threshold)

    def run(batches):
        for batch in decode(batches):
            vectors = [np.array(v, kind).tobytes() for v in batch.column(1).to_pylist()]
            lists = [np.array(c, np.int64).tobytes() for c in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(vectors, pa.binary()), batch.column(2), batch.column(3),
                 pa.array(lists, pa.binary())],
                names=["uid", "vector", "size", "caps", "packed"])

    return run


def near_duplicates(rows, threshold=THRESHOLD, id_column="vec_id", vector_column="embedding"):
    """``(id, n_links, component_id, kept)`` per row, by cosine of at least ``threshold``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    that links reach, ``kept`` whether that is the row's own. Vectors that are null, empty,
    zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows with a null id count as links of others and are not kept.

    Equal vectors are one class, so copies are never paired. Each class's vector goes to
    all caps of the product codes that it lies in, and is compared in double precision
    with the others there. A pair at the threshold is missed with probability ``MISS``,
    however its components are spread and however many vectors there are; the number of
    codes is chosen for that. A cap that holds many vectors is cut into blocks, and every two
    blocks meet in a task of their own. A pair counts in the smallest cap it shares; only
    sums and a spanning forest leave a task, never the pairs.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    given = rows.select(
        F.col(id_column).alias("_id"), F.col(vector_column).cast("array<double>").alias("_v"))
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "_v", lambda x: x != 0)
    given = given.withColumn("_fine", F.coalesce(fine, F.lit(False)))
    classes = given.where("_fine").groupBy(F.col("_v").alias("vector")).agg(
        F.count("*").alias("size"), F.min("_id").alias("first"))
    classes = scratch.write(classes.withColumn("uid", F.monotonically_increasing_id()), "classes")

    words = code_size(classes.count())
    # Single-precision input is shuffled as such; it is compared in double precision all the same.
    single = rows.schema[vector_column].dataType == T.ArrayType(T.FloatType())
    kind = np.dtype(np.float32 if single else np.float64)
    decoded = classes.select("uid", "vector", "size").mapInArrow(
        _packed(words, threshold, kind), "uid long, vector binary, size long, caps array<long>, packed binary")
    decoded = scratch.write(decoded, "decoded")
    # The length of the vector is part of the key: vectors of another length have other caps.
    cap = F.explode("caps").alias("cap")
    length = (F.length("vector") / kind.itemsize).cast("int").alias("length")
    crowded = decoded.select(cap, length).groupBy("cap", "length").agg(F.count("*").alias("n"))
    crowded = scratch.write(crowded.where(F.col("n") > 1).select(
        "cap", "length", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "crowded")
    members = decoded.select("uid", "vector", "size", "packed", cap, length).join(crowded, ["cap", "length"])
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.withColumn("own", own).withColumn("other", other)
    keys = ["length", "cap", "low", "high"]
    grouped = dealt.select(
        "length", "cap", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "uid", F.col("own").alias("side"), "size", "vector", "packed")
    grouped = grouped.repartition(*keys).sortWithinPartitions(*keys, "uid")
    linked = grouped.mapInArrow(_linked(threshold, kind), "uid long, links long, root long")
    linked = scratch.write(linked, "linked")
    scratch.drop("decoded", "crowded")

    sums = linked.groupBy("uid").agg(F.sum("links").alias("links"))
    edges = linked.where("uid <> root").select(F.col("uid").alias("a"), F.col("root").alias("b"))
    reached = components(edges, scratch)
    placed = classes.join(sums, "uid", "left").join(reached, F.col("uid") == F.col("node"), "left").select(
        "vector", "first", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "uid").alias("component"))
    placed = scratch.write(placed, "placed")
    # Staged, since adaptive execution splits a large component only in a join of two plain shuffles.
    smallest = scratch.write(placed.groupBy("component").agg(F.min("first").alias("smallest")), "smallest")
    final = scratch.write(
        placed.join(smallest, "component").select("vector", "n_links", "smallest"), "final")
    scratch.drop("classes", "linked", "placed", "smallest")
    found = given.join(final, F.col("_fine") & (F.col("_v") == F.col("vector")), "left")
    component = F.coalesce("smallest", "_id")
    return found.select(
        F.col("_id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"))
