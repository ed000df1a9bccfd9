"""Removal of word windows that an earlier document has, by level-wise doubling."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch
from tierlake.llm.hashing import blocks, window_hashes, word_hashes
from tierlake.llm.words import segments, utf8, words_and_sha

WINDOW = 13
SHORTEST = 8  # the first level's windows are at most this long


def levels(window):
    """Window lengths from the first level up to ``window``; each is at most twice the last."""
    found = [window]
    while found[0] > SHORTEST:
        found.insert(0, -(-found[0] // 2))
    return found


class Windows:
    """Windows of some texts at one level. ``valid`` marks those that lie within one text."""

    def __init__(self, texts, size):
        self.hashes, self.owner = word_hashes(texts)
        self.size = size
        self.valid = self._inside(size)

    def _inside(self, size):
        n = max(len(self.owner) - size + 1, 0)
        return self.owner[:n] == self.owner[size - 1:size - 1 + n] if n else np.zeros(0, bool)

    def keys(self, size, which=0):
        """Hash of each window by the first or the second hash of its words."""
        return window_hashes(np.ascontiguousarray(self.hashes[:, which]), size)

    def least(self, size):
        """For each window: the least hash of the windows of ``size`` words inside it."""
        part = self.keys(size)
        n = max(len(self.owner) - self.size + 1, 0)
        least = part[:n].copy()
        for shift in range(1, self.size - size + 1):
            np.minimum(least, part[shift:shift + n], out=least)
        return least

    def candidates(self, known, below, sampled):
        """Mask of the windows whose halves are in ``known``: ``(owner, hash)`` as two arrays."""
        if not len(self.valid):
            return self.valid
        if sampled:
            return self.valid & _known(self.owner[:len(self.valid)], self.least(below), *known)
        part, n = self.keys(below), len(self.valid)
        owner, shift = self.owner[:n], self.size - below
        return (self.valid & _known(owner, part[:n], *known)
                & _known(owner, part[shift:shift + n], *known))


def _known(owner, hashes, known_owner, known_hashes):
    """Which ``(owner, hash)`` are among the known ones."""
    if not len(known_hashes):
        return np.zeros(len(hashes), bool)

    def keyed(o, h):
        # Owners are numbers within a block: a different one shifts the hash far away.
        return h + o.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)

    table = np.sort(keyed(known_owner, known_hashes))
    wanted = keyed(owner, hashes)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return table[at] == wanted


def _columns(batch, *names):
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def _texts(column):
    return [utf8(text) for text in column.to_pylist()]


def _sets(column, first, count):
    """``(owner, hash)`` of the array column's rows ``first`` to ``first + count``."""
    part = column.slice(first, count)
    offsets = part.offsets.to_numpy()
    values = part.values.to_numpy()[offsets[0]:offsets[-1]].view(np.uint64)
    return np.repeat(np.arange(count), np.diff(offsets)), values


def _facts(batches):
    """``(id, words_sha, n_words)`` of each text."""
    for batch in batches:
        ids, texts = _columns(batch, "_id", "_text")
        found = [words_and_sha(text) for text in _texts(texts)]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([sha for _, sha in found], pa.string()), pa.array([n for n, _ in found], pa.int64())],
            names=["_id", "words_sha", "n_words"])


def _kept_sha(text, gone):
    """SHA-256 of the words that stay, joined by one space."""
    digest, at, first = hashlib.sha256(), 0, True
    for part in segments(text):
        own = part.split()
        kept = [w for w, g in zip(own, gone[at:at + len(own)].tolist()) if not g]
        if kept:
            digest.update((b"" if first else b" ") + b" ".join(kept))
            first = False
        at += len(own)
    return digest.hexdigest()


def _first_level(lengths):
    """Rows ``(id, key)``: of each window of the second length, its least window of the first."""

    def run(batches):
        for batch in batches:
            ids, texts = _columns(batch, "_id", "_text")
            ids = ids.to_numpy(zero_copy_only=False)
            for first, part in blocks(_texts(texts)):
                if len(lengths) == 1:
                    windows = Windows(part, lengths[0])
                    least = windows.keys(lengths[0])
                else:
                    windows = Windows(part, lengths[1])
                    least = windows.least(lengths[0])
                owner = windows.owner[:len(least)]
                fresh = windows.valid.copy()
                if len(fresh):
                    fresh[1:] &= (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~windows.valid[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first + owner[fresh]]), pa.array(least[fresh].view(np.int64))],
                    names=["_id", "key"])

    return run


def _next_level(size, below, sampled, both):
    """Rows ``(id, key[, key2])`` of the windows of ``size`` words whose halves survived."""

    def run(batches):
        for batch in batches:
            ids, texts, known = _columns(batch, "_id", "_text", "known")
            ids = ids.to_numpy(zero_copy_only=False)
            for first, part in blocks(_texts(texts)):
                windows = Windows(part, size)
                mask = windows.candidates(_sets(known, first, len(part)), below, sampled)
                owner = windows.owner[:len(mask)][mask]
                columns = [pa.array(ids[first + owner])]
                for which in (0, 1)[:1 + both]:
                    columns.append(pa.array(windows.keys(size, which)[mask].view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "key", "key2"][:2 + both])

    return run


def _cover(size):
    """Removed words of each text: those in a window whose hash is in ``known``."""

    def run(batches):
        for batch in batches:
            ids, texts, *known = _columns(batch, "_id", "_text", "known", "known2")
            rows = []
            for first, part in blocks(_texts(texts)):
                windows = Windows(part, size)
                mask = windows.valid
                for which, keys in enumerate(known):
                    mask = mask & _known(
                        windows.owner[:len(mask)], windows.keys(size, which), *_sets(keys, first, len(part)))
                covered = np.zeros(len(windows.owner) + 1, np.int64)
                at = np.flatnonzero(mask)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + size, -1)
                removed = np.cumsum(covered[:-1]) > 0
                edges = np.searchsorted(windows.owner, np.arange(len(part) + 1))
                for text, low, high in zip(part, edges, edges[1:]):
                    gone = removed[low:high]
                    steps = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    rows.append((
                        words_and_sha(text)[1], int(gone.sum()), _kept_sha(text, gone),
                        [{"start": int(a), "end": int(b)} for a, b in steps.reshape(-1, 2)]))
            columns = list(zip(*rows)) or [[]] * 4
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = [pa.string(), pa.int64(), pa.string(), span]
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                names=["_id", "words_sha", "n_removed", "kept_sha256", "removed"])

    return run


def _shared(rows, keys, scratch, label):
    """The keys that at least two ids have, with the least id as ``first``.

    Ends are combined before they are shuffled. The result is staged, since adaptive
    execution splits a key that very many rows have only in a join of two plain shuffles.
    """
    ends = rows.groupBy(*keys).agg(F.min("_id").alias("first"), F.max("_id").alias("last"))
    return scratch.write(ends.where("first < last").drop("last"), label)


def _survivors(rows, scratch, label):
    """``(id, known)``: the keys of each id that another id has, too."""
    shared = _shared(rows, ["key"], scratch, label)
    return rows.join(shared, "key").groupBy("_id").agg(F.collect_set("key").alias("known"))


def repeated_spans(docs, window=WINDOW, id_column="doc_id", text_column="text"):
    """What to remove from each text: words in a ``window`` that starts in a smaller id as well.

    Returns ``(id, n_words, n_removed, kept_sha256, removed)`` per row; ``removed`` holds word
    ranges ``(start, end)``, ``kept_sha256`` the SHA-256 of the kept words joined by one space.

    Level by level, windows that occur in one document only are dropped and the rest are
    extended to twice their length, until ``window`` is reached or no candidate survives.
    The first level takes, for each window of the second level, the one with the least
    hash of the windows inside it: a window that two documents share has the same one in
    both, so nothing is lost, while only every fourth window or so is shuffled. The last
    level compares two hashes of 64 bits, which are independent from the words on.

    Documents with the same words as one of a smaller id are removed as a whole, without
    being compared. A null text has no words. Rows with a null id are kept whole and do
    not count as a source. Rows that repeat an id do not remove each other, and all stay.
    """
    if window < 1:
        raise ValueError("window must be positive")
    scratch = Scratch(docs.sparkSession)
    given = docs.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    facts = scratch.write(
        given.mapInArrow(_facts, "_id long, words_sha string, n_words long"), "facts")
    originals = _shared(facts, ["words_sha"], scratch, "originals").withColumnRenamed("first", "original")
    facts = scratch.write(facts.join(originals, "words_sha", "left").withColumn(
        "is_copy", F.coalesce((F.col("_id") > F.col("original")) & (F.col("n_words") >= window), F.lit(False))
    ).drop("original"), "marked")
    copies = facts.groupBy("_id").agg(F.every("is_copy").alias("gone")).where("gone").select("_id")

    lengths = levels(window)
    present = given.where("_id IS NOT NULL")
    rows = present.mapInArrow(_first_level(lengths), "_id long, key long")
    known = _survivors(rows, scratch, "shared0").join(copies, "_id", "left_anti")
    known = scratch.write(known, "known0")
    scratch.drop("shared0")
    candidates = scratch.write(present.join(known, "_id"), "candidates0")
    turn = 0
    for below, size in zip(lengths, lengths[1:-1]):
        rows = candidates.mapInArrow(_next_level(size, below, turn == 0, False), "_id long, key long")
        known = scratch.write(_survivors(rows, scratch, f"shared{turn + 1}"), f"known{turn + 1}")
        if known.isEmpty():
            break
        longer = candidates.drop("known").join(known, "_id")
        candidates = scratch.write(longer, f"candidates{turn + 1}")
        scratch.drop(f"candidates{turn}", f"known{turn}")
        turn += 1

    if len(lengths) == 1:
        windows = candidates.mapInArrow(_next_level(window, window, False, True), "_id long, key long, key2 long")
    else:
        below = lengths[-2]
        windows = candidates.mapInArrow(
            _next_level(window, below, len(lengths) == 2, True), "_id long, key long, key2 long")
    firsts = _shared(windows, ["key", "key2"], scratch, "firsts")
    later = windows.join(firsts, ["key", "key2"]).where("_id > first")
    covered = later.groupBy("_id").agg(F.collect_set(F.struct("key", "key2")).alias("known"))
    covered = scratch.write(covered.select(
        "_id", F.col("known.key").alias("known"), F.col("known.key2").alias("known2")), "covered")
    spans = "array<struct<start:int,end:int>>"
    cut = candidates.drop("known").join(covered, "_id").mapInArrow(
        _cover(window), f"_id long, words_sha string, n_removed long, kept_sha256 string, removed {spans}")
    cut = scratch.write(cut.dropDuplicates(["_id", "words_sha"]), "cut")
    scratch.drop("facts", "originals", f"candidates{turn}", f"known{turn}", "covered", "firsts")

    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    nothing = F.sha2(F.lit(""), 256)
    return facts.join(cut, ["_id", "words_sha"], "left").select(
        F.col("_id").alias(id_column), "n_words",
        F.when(F.col("is_copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(F.col("is_copy"), nothing).otherwise(F.coalesce("kept_sha256", "words_sha")).alias("kept_sha256"),
        F.when(F.col("is_copy"), whole).otherwise(F.coalesce("removed", F.array().cast(spans))).alias("removed"))
