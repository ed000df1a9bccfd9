"""Packing token sequences along a Hilbert curve through hashed document vectors."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tierlake.llm.common import Scratch
from tierlake.llm.tokens import TOKENIZER, encoder

END = 1
SEQUENCE = 2048
BUCKETS, DIMENSIONS, BITS = 256, 3, 16


def hilbert(points, bits=BITS):
    """Place of integer points (one row each) on the Hilbert curve through their cube."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            set_ = (x[i] & bit) != 0
            x[0] = np.where(set_, x[0] ^ low, x[0])
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ swap
            x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - 1), turn)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> b) & 1)
    return key


def _projection():
    """Fixed Gaussian directions, and the bucket and sign of each token id."""
    return np.random.Generator(np.random.PCG64(7)).standard_normal((BUCKETS, DIMENSIONS))


def curve_keys(documents):
    """Hilbert keys of documents given as id arrays: hashed root counts, projected and cut to a grid."""
    vectors = np.zeros((len(documents), BUCKETS))
    for row, ids in zip(vectors, documents):
        hashed = ids.astype(np.uint32) * np.uint32(2654435761)
        row += np.sqrt(np.bincount(hashed >> np.uint32(24), minlength=BUCKETS))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    points = (vectors @ _projection() + 4) / 8 * (1 << BITS)
    return hilbert(np.clip(points, 0, (1 << BITS) - 1).astype(np.int64))


def _encode(tokenizer):
    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            documents = [np.array(encode(text or "") + [END], np.uint16) for text in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("_id")),
                pa.array(curve_keys(documents)),
                pa.array([len(ids) for ids in documents], pa.int64()),
                pa.array([ids.tobytes() for ids in documents], pa.binary()),
            ], names=["_id", "curve", "doc_tokens", "ids"])

    return run


def _running(batches):
    """``(uid, part, before)``: tokens of the partition's rows before each row."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        tokens = batch.column(batch.schema.get_field_index("doc_tokens")).to_numpy()
        ends = total + np.cumsum(tokens)
        yield pa.RecordBatch.from_arrays([
            batch.column(batch.schema.get_field_index("uid")),
            pa.array(np.full(len(tokens), part, np.int32)),
            pa.array(ends - tokens), pa.array(tokens),
        ], names=["uid", "part", "before", "tokens"])
        total = int(ends[-1]) if len(ends) else total


def cuts(start, stop, total, size=SEQUENCE):
    """Pieces ``(from, to, sequence, offset)`` of the token positions ``start`` to ``stop``.

    All sequences are full but those at the end of the ``total`` tokens: what is left
    over is cut into powers of two, which need no padding.
    """
    full = total // size * size
    at = start
    while at < stop:
        if at < full:
            sequence, first = at // size, at // size * size
            last = first + size
        else:
            sequence, first, left = full // size, full, total - full
            while True:
                last = first + (1 << (left.bit_length() - 1))
                if at < last:
                    break
                left, first, sequence = left - (last - first), last, sequence + 1
        end = min(stop, last)
        yield at, end, sequence, at - first
        at = end


def _pieces(total, size):
    def run(batches):
        for batch in batches:
            given = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            starts = given["start"].to_pylist()
            row, columns = [], [[] for _ in range(5)]
            for i, (at, ids) in enumerate(zip(starts, given["ids"])):
                ids = np.frombuffer(ids.as_buffer(), np.uint16).astype("<u4")
                for low, high, sequence, offset in cuts(at, at + len(ids), total, size):
                    row.append(i)
                    piece = ids[low - at:high - at].tobytes()
                    for column, value in zip(columns, (low - at, high - low, piece, sequence, offset)):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [given["_id"].take(rows), given["doc_tokens"].take(rows), *made],
                names=["_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"])

    return run


def pack(docs, id_column="doc_id", text_column="text", tokenizer=TOKENIZER, size=SEQUENCE):
    """Pieces of all documents in sequences of ``size`` tokens, neighbours on the curve together.

    Returns ``(id, start, length, ids, doc_tokens, sequence_id, offset)``; ``ids`` are
    little-endian 32-bit token ids. Each text is tokenized once, ends with id 1 (null and
    empty texts are that id alone), and is cut wherever a sequence ends, so there is no
    padding. Rows that repeat an id are packed one by one; equal keys go by id.

    Only narrow rows (key, id, length) are range-sorted. Their running sums in each
    partition are staged, one number per partition gives where it begins, and the tokens
    then meet their position in one join.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    given = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    kind = given.schema["_id"].dataType.simpleString()
    encoded = given.mapInArrow(
        _encode(tokenizer), f"_id {kind}, curve long, doc_tokens long, ids binary")
    encoded = scratch.write(encoded.withColumn("uid", F.monotonically_increasing_id()), "encoded")

    keys = encoded.select("curve", "_id", "uid", "doc_tokens")
    ordered = keys.repartitionByRange("curve", "_id", "uid").sortWithinPartitions("curve", "_id", "uid")
    ordered = scratch.write(
        ordered.mapInArrow(_running, "uid long, part int, before long, tokens long"), "ordered")
    sums = ordered.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect()
    total, begins = 0, []
    for row in sums:
        begins.append((row["part"], total))
        total += row["n"]
    # One row per partition of the range sort, whose number is a setting.
    begins = spark.createDataFrame(begins, "part int, begin long")
    placed = ordered.join(F.broadcast(begins), "part").select(
        "uid", (F.col("begin") + F.col("before")).alias("start"))
    located = encoded.select("uid", "_id", "doc_tokens", "ids").join(placed, "uid").drop("uid")
    pieces = located.mapInArrow(
        _pieces(total, size),
        f"_id {kind}, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long")
    return pieces.select(
        F.col("_id").alias(id_column), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def sequences(pieces):
    """``(sequence_id, ids)``: each sequence's pieces in order, as one binary of 32-bit ids.

    A sequence holds a bounded number of tokens, so its pieces fit one row.
    """
    piece = F.struct("offset", "ids")
    return pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
