import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import SF_DIR, edge_docs
from tierlake.llm import packing
from tierlake.llm.queries import QUERIES, packed


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(rows, texts, tokenizer):
    """Each id in one piece with the right checksum; sequences without gaps or padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, text in texts.items():
        ids, at = ids_of(tokenizer, text), 0
        for r in sorted(pieces.pop(doc_id), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(ids[at:at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SEQUENCE and at & (at - 1) == 0
    assert sorted(sequences) == list(range(len(sequences)))


def test_query_round_trip(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check(QUERIES["op3_hilbert_packing"](spark, SF_DIR).collect(), texts, tokenizer)


def test_edges(spark, tokenizer):
    docs = edge_docs(spark).where("doc_id IS NULL OR doc_id <> 4")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check(packed(docs).collect(), texts, tokenizer)
    repeated = packed(edge_docs(spark).where("doc_id = 4")).collect()
    assert sum(r["length"] for r in repeated) == sum(
        len(ids_of(tokenizer, r["text"])) for r in edge_docs(spark).where("doc_id = 4").collect())
    assert packed(docs.limit(0)).count() == 0


def test_sequences_hold_the_tokens(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four five " * 3000)], "doc_id long, text string")
    rows = packing.sequences(packing.pack(docs)).orderBy("sequence_id").collect()
    got = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    first, second = ids_of(tokenizer, "one two three"), ids_of(tokenizer, "four five " * 3000)
    assert got.tolist() in [[*first, *second], [*second, *first]]


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3)])
def test_curve_visits_neighbours(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    points = np.stack([a.ravel() for a in axes], axis=1)
    keys = packing.hilbert(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_similar_documents_are_near():
    base = np.random.default_rng(1).integers(0, 50_000, 500).astype(np.uint16)
    near = base.copy()
    near[:3] = 7
    others = [np.random.default_rng(i).integers(0, 50_000, 500).astype(np.uint16) for i in range(2, 60)]
    keys = packing.curve_keys([base, near, *others])
    order = np.argsort(keys).tolist()
    assert abs(order.index(0) - order.index(1)) <= 3


@pytest.mark.parametrize("total", [1, 5, 2048, 2049, 4095, 5000])
def test_cuts(total):
    for start, stop in [(0, total), (total // 3, total)]:
        pieces = list(packing.cuts(start, stop, total))
        assert [p[0] for p in pieces] == [start, *[p[1] for p in pieces[:-1]]]
        assert pieces[-1][1] == stop
