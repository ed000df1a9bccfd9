"""Interaction of document filters, from sorted posting lists of the ids that fail each filter."""

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch
from tierlake.llm.words import segments, utf8

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COPY = 1 << FILTERS.index("E")  # the filter that a text alone does not decide
SETS = 1 << len(FILTERS)
RANGE = 1 << 16  # most ids of one posting list
LISTS = [*FILTERS, "good", "toxic"]
_BLOCK = 64


def failures(text):
    """Bits of the filters A to D that a text fails; bit 0 is A."""
    raw, count, distinct = utf8(text), 0, set()
    for part in segments(raw):
        own = part.split()
        count += len(own)
        distinct.update(own)
    upper = len(raw) - len(raw.translate(None, UPPER))
    symbols = len(raw.translate(None, SYMBOLS)) < len(raw)
    fails = [
        count < LEAST_WORDS, 100 * len(distinct) < LEAST_DISTINCT_PERCENT * count,
        100 * upper > MOST_UPPER_PERCENT * len(text or ""), symbols,
    ]
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


def _measured(batches):
    """``(_id, part, mask, digest)``: the filters A to D, and the SHA-256 of the whole text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("_text"))
        masks, digests = [], []
        for text in texts:  # one at a time: texts can be very long
            text = text.as_py()
            masks.append(failures(text))
            digests.append(hashlib.sha256(utf8(text)).digest())
        yield pa.RecordBatch.from_arrays([
            batch.column(batch.schema.get_field_index("_id")),
            batch.column(batch.schema.get_field_index("part")),
            pa.array(masks, pa.int32()), pa.array(digests, pa.binary()),
        ], names=["_id", "part", "mask", "digest"])


def places(ids, among):
    """Where each of the sorted ``ids`` stands, or would stand, in the sorted list ``among``.

    Gallops: for every block of ids the step from where the last one ended doubles until it
    is past the block, and only the stretch in between is searched.
    """
    found, at = np.empty(len(ids), np.int64), 0
    for first in range(0, len(ids), _BLOCK):
        block, step = ids[first:first + _BLOCK], _BLOCK
        while at + step < len(among) and among[at + step] < block[-1]:
            step *= 2
        found[first:first + len(block)] = at + np.searchsorted(among[at:at + step + 1], block)
        at = int(found[first + len(block) - 1])
    return found


def difference(ids, other):
    """The sorted ``ids`` that are not in ``other``; the shorter list gallops through the longer."""
    if not len(ids) or not len(other):
        return ids
    if len(ids) <= len(other):
        place = places(ids, other)
        return ids[other[np.minimum(place, len(other) - 1)] != ids]
    place = places(other, ids)
    gone = place[ids[np.minimum(place, len(ids) - 1)] == other]
    return np.delete(ids, gone)


def union(*lists):
    """All ids of some sorted lists, each once and in order: merged from the shortest on."""
    merged, *rest = sorted(lists, key=len)
    for longer in rest:
        fresh = difference(merged, longer)
        merged = np.insert(longer, places(fresh, longer), fresh)
    return merged


def sizes(lists):
    """Sizes of all unions and differences of one id range.

    ``lists`` are the posting lists of the filters, then the good and the toxic ids. The result
    has three rows (all, good, toxic) of ``(filters + 1) * SETS`` numbers: ``f * SETS + s`` is
    the size of list f without the union of the set s, and the last ``SETS`` are the unions.
    """
    *failing, good, toxic = lists
    empty = failing[0][:0]
    unions = [empty]
    for chosen in range(1, SETS):
        unions.append(union(*[ids for bit, ids in enumerate(failing) if chosen >> bit & 1]))
    made = np.zeros((3, (len(failing) + 1) * SETS), np.int64)
    for f in range(len(failing) + 1):
        for chosen in range(SETS):
            if f == len(failing):
                ids = unions[chosen]
            elif chosen >> f & 1:
                continue
            else:
                ids = difference(failing[f], unions[chosen])
            for row, marked in enumerate([None, good, toxic]):
                made[row, f * SETS + chosen] = (
                    len(ids) if marked is None else len(ids) - len(difference(ids, marked)))
    return made


def _id_ranges(batches):
    """Sorted rows in tables of up to ``RANGE`` rows."""
    kept, rows = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, RANGE):
            part = batch.slice(first, RANGE)
            if rows + part.num_rows > RANGE:
                yield pa.Table.from_batches(kept)
                kept, rows = [], 0
            kept.append(part)
            rows += part.num_rows
    if rows:
        yield pa.Table.from_batches(kept)


def _postings(batches):
    """Posting lists of each id range: rows ``(part, copies, n, first, last, A, ..., good, toxic)``."""
    for table in _id_ranges(batches):
        known = table["_id"].is_valid().to_numpy()
        ids = table["_id"].fill_null(0).to_numpy()
        masks, good, toxic = (table[name].to_numpy() for name in ("mask", "good", "toxic"))
        groups = {}
        for at, key in enumerate(zip(*[table[c].to_pylist() for c in ("part", "copies", "kind")], known.tolist())):
            groups.setdefault(key, []).append(at)
        made = {name: [] for name in ["part", "copies", "n", "first", "last", *LISTS]}
        for (part, copies, _, _), rows in groups.items():
            own, mask = ids[rows], masks[rows]
            for name, value in zip(made, (part, copies, len(own), own[0], own[-1])):
                made[name].append(value)
            for bit, name in enumerate(FILTERS):
                made[name].append(own[mask >> bit & 1 == 1])
            made["good"].append(own[good[rows].astype(bool)])
            made["toxic"].append(own[toxic[rows].astype(bool)])
        arrays = [pa.array(made["part"], pa.string())]
        arrays += [pa.array(made[name], pa.int64()) for name in ("copies", "n", "first", "last")]
        arrays += [pa.array(made[name], pa.list_(pa.int64())) for name in LISTS]
        yield pa.RecordBatch.from_arrays(arrays, names=list(made))


def _summed(batches):
    """``(part, n, at, removed, good, toxic)``: sizes of each id range times its rows' copies."""
    for batch in batches:
        given = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            lists = [np.asarray(given[name][i].values.to_numpy(zero_copy_only=False)) for name in LISTS]
            copies = given["copies"][i].as_py()
            made = sizes(lists) * copies
            at = np.flatnonzero(made[0])
            at = at if len(at) else np.zeros(1, np.int64)
            n = np.zeros(len(at), np.int64)
            n[0] = given["n"][i].as_py() * copies
            yield pa.RecordBatch.from_arrays([
                pa.array([given["part"][i].as_py()] * len(at), pa.string()),
                pa.array(n), pa.array(at), *[pa.array(row[at]) for row in made],
            ], names=["part", "n", "at", "removed", "good", "toxic"])


def postings(docs, labels, id_column="doc_id", text_column="text", part_column="lang"):
    """Sorted lists of failing ids per part and filter, one row per range of ids.

    Returns ``(part, copies, n, first, last, A, B, C, D, E, good, toxic)``: ``n`` rows of a part,
    with ids from ``first`` to ``last``, of which those in list ``A`` fail that filter and those
    in ``good`` have a label ``quality = 1``; ``copies`` is how often each of these rows occurs.
    An id that has several kinds of rows (in one part with other texts, say) has them in
    different rows of the result, so that a list never repeats an id.

    Filters: A fewer than 100 words; B fewer than 80 distinct words in 100; C more than 10
    letters A-Z in 100 code points; D any of ``#$%&*|``; E the same text as a smaller id, in any
    part. Null texts are empty, a null part is the empty string, and ids are whole numbers. A
    row without an id is nobody's copy, and no other row's original; it has no labels and stands
    in lists of its own, as id 0. With several labels for an id, one that says 1 counts.
    Repeated rows count each. Other columns are ignored.

    Only ids, bits and digests are shuffled. Ranges are cut by a range sort of all rows, so a
    part with most of the rows is spread like any other; lists hold at most 65,536 ids.
    """
    scratch = Scratch(docs.sparkSession)
    given = docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.col(text_column).cast("string").alias("_text"))
    measured = scratch.write(
        given.mapInArrow(_measured, "_id long, part string, mask int, digest binary"), "measured")
    # Staged, since adaptive execution splits a text of very many copies only in a join of two
    # plain shuffles.
    originals = scratch.write(
        measured.groupBy("digest").agg(F.min("_id").alias("original"), F.max("_id").alias("_last"))
        .where("original < _last").select("digest", "original"), "originals")
    copy = F.when(F.col("_id") > F.col("original"), COPY).otherwise(0)
    judged = measured.join(originals, "digest", "left").select(
        "_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))
    kinds = judged.groupBy("_id", "part", "mask").agg(F.count("*").alias("copies")).select(
        "_id", F.struct("part", "mask", "copies").alias("kind"),
        F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    marks = labels.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("_id"), F.lit(None).alias("kind"),
        *[F.coalesce(F.col(column) == 1, F.lit(False)).alias(name)
          for column, name in [("quality", "good"), ("toxic", "toxic")]])
    # Labels come along as rows of their id: no join, and at most a few rows per id and task.
    by_id = kinds.unionByName(marks).groupBy("_id").agg(
        F.sort_array(F.collect_list("kind")).alias("kinds"),
        F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = by_id.select("_id", "good", "toxic", F.posexplode("kinds").alias("kind", "own")).select(
        "own.part", "_id", "kind", "own.copies", "own.mask", "good", "toxic")
    order = ["part", "_id", "kind"]
    lists = ", ".join(f"{name} array<long>" for name in LISTS)
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _postings, f"part string, copies long, n long, first long, last long, {lists}")
    found = scratch.write(ranges, "postings")
    scratch.drop("measured", "originals")
    return found


def interactions(posted):
    """What each filter does at each place of each order, per part, from :func:`postings`.

    Rows ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley)`` for all orders of the five filters and their five steps; numbers are
    rows of the part. An empty table has no parts.

    Every id range is merged by itself, and only sizes are summed: 192 numbers for a range.
    """
    summed = posted.mapInArrow(
        _summed, "part string, n long, at long, removed long, good long, toxic long")
    numbers = ("removed", "good", "toxic")
    totals = summed.groupBy("part", "at").agg(*[F.sum(c).alias(c) for c in ("n", *numbers)])
    by_part = totals.groupBy("part").agg(
        F.sum("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("at", F.struct(*numbers)))).alias("size"))

    def size(at, number):
        return F.coalesce(F.try_element_at("size", at.cast("long"))[number], F.lit(0).cast("long"))

    def place(column):
        return F.instr(F.lit(FILTERS), column) - 1

    def set_of(letters):
        return sum(F.when(F.instr(letters, name) > 0, 1 << bit).otherwise(0) for bit, name in enumerate(FILTERS))

    orders = F.split(F.lit(" ".join("".join(order) for order in permutations(FILTERS))), " ")
    steps = by_part.select("part", "n", "size", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    before = set_of(F.substring("filter_order", F.lit(1), F.col("step") - 1))
    after = set_of(F.substring("filter_order", F.lit(1), F.col("step")))
    steps = steps.withColumns({"f": place(own), "before": before, "after": after})
    at = F.col("f") * SETS
    shapley = None
    for f, name in enumerate(FILTERS):
        value = sum(
            size(F.lit(f * SETS + chosen), "removed")
            * factorial(chosen.bit_count()) * factorial(len(FILTERS) - 1 - chosen.bit_count())
            for chosen in range(SETS) if not chosen >> f & 1)
        shapley = F.when(F.col("f") == f, value) if shapley is None else shapley.when(F.col("f") == f, value)
    removed = size(at + F.col("before"), "removed")
    others = SETS - 1 - F.call_function("shiftleft", F.lit(1), F.col("f").cast("int"))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("n") - size(F.lit(len(FILTERS) * SETS) + F.col("after"), "removed")).alias("kept"),
        removed.alias("removed"), (size(at, "removed") - removed).alias("redundant"),
        size(at + others, "removed").alias("unique_fails"),
        size(at + F.col("before"), "good").alias("good_lost"),
        size(at + F.col("before"), "toxic").alias("toxic_lost"), shapley.alias("shapley"))
