import hashlib
import random

import pytest

from tests.llm.helpers import edge_docs, words
from tierlake.llm import hashing, substrings


def plain(rows, window):
    """(id, text) rows -> (id, n_words, n_removed, sha) rows."""
    first = {}
    for i, text in rows:
        own = words(text)
        for k in range(len(own) - window + 1):
            key = tuple(own[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        own = words(text)
        gone = set()
        for k in range(len(own) - window + 1):
            if i is not None and first[tuple(own[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def shared_passages(seed, documents=60):
    """Documents put together from fresh words and from passages of many lengths."""
    draw = random.Random(seed)
    passages = [[f"p{n}w{k}" for k in range(draw.randrange(5, 120))] for n in range(12)]
    rows = []
    for i in range(documents):
        own = []
        for part in range(draw.randrange(0, 6)):
            if draw.random() < 0.6:
                passage = draw.choice(passages)
                low = draw.randrange(len(passage))
                own += passage[low:low + draw.randrange(1, 80)]
            else:
                own += [f"d{i}w{part}x{k}" for k in range(draw.randrange(1, 40))]
        rows.append((draw.randrange(documents), draw.choice([" ", "\n", " \t"]).join(own)))
    return rows


def got(frame):
    return sorted([tuple(r)[:4] for r in frame.collect()], key=str)


@pytest.mark.parametrize("window", [1, 5, 13, 50])
def test_equals_brute_force(spark, window):
    rows = shared_passages(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substrings.repeated_spans(docs, window)) == plain(rows, window)


def test_levels():
    assert substrings.levels(13) == [7, 13]
    assert substrings.levels(50) == [7, 13, 25, 50]
    assert substrings.levels(8) == [8]


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(substrings.repeated_spans(docs)) == plain(rows, 13)
    assert got(substrings.repeated_spans(docs, 4)) == plain(rows, 4)
    assert substrings.repeated_spans(docs.limit(0)).count() == 0


def test_removed_ranges(spark):
    rows = [(1, " ".join(f"a{k}" for k in range(20))), (2, "x y " + " ".join(f"a{k}" for k in range(3, 18)) + " z")]
    found = substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: [tuple(s) for s in r["removed"]] for r in found.collect()} == {1: [], 2: [(2, 17)]}


def thue_morse(length, first="a", second="b"):
    """A word and its complement: sums over powers cannot tell them apart."""
    bits = [bin(n).count("1") % 2 for n in range(length)]
    return "".join((first, second)[b] for b in bits), "".join((second, first)[b] for b in bits)


@pytest.mark.parametrize("window", [1, 2, 13, 50])
def test_long_words_of_any_pattern(spark, window):
    """Windows that differ in one word, whose letters follow a pattern."""
    rows, common = [], [f"w{k}" for k in range(window - 1)]
    for n, length in enumerate([1024, 4096, 1 << 16]):
        one, other = thue_morse(length)
        rows += [(10 * n + 1, " ".join([*common, one])), (10 * n + 2, " ".join([*common, other])), (10 * n + 3, " ".join([*common, one]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substrings.repeated_spans(docs, window)) == plain(rows, window)


def test_windows_of_any_pattern(spark):
    """Words that follow the pattern, over windows longer than it."""
    one, other = thue_morse(2048)
    rows = [(1, " ".join(one)), (2, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substrings.repeated_spans(docs, 2048)) == plain(rows, 2048)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 13, 20])
def test_window_hashes(size):
    draw = random.Random(size)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randrange(60))).encode() for _ in range(40)]
    hashes, owner = hashing.word_hashes(texts)
    own = [w for t in texts for w in t.split()]
    assert [texts[n].split().count(w) > 0 for n, w in zip(owner.tolist(), own)] == [True] * len(own)
    for which in (0, 1):
        keys = hashing.window_hashes(hashes[:, which], size).tolist()
        windows = [tuple(own[k:k + size]) for k in range(len(own) - size + 1)]
        assert len(keys) == len(windows) and len(set(zip(keys, windows))) == len(set(keys)) == len(set(windows))


@pytest.mark.parametrize("longest", [8, 256])
def test_word_hashes(monkeypatch, longest):
    """Equal words have equal hashes wherever they lie, different ones do not."""
    monkeypatch.setattr(hashing, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(hashing, "LONG_WORD", longest)
    draw = random.Random(3)
    known = ["a", "a\0", "\0", "\0\0", "é", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "x" * 300, "x" * 301, "y" * 300]
    known += ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 40))) for _ in range(300)]
    texts = ["".join(draw.choice(known) + draw.choice([" ", "\n", " \t"]) for _ in range(draw.randrange(120))).encode() for _ in range(60)]
    texts += [b"", b" ", b"w", b" w", b"w "]
    hashes, owner = hashing.word_hashes(texts)
    words = [(n, w) for n, t in enumerate(texts) for w in t.split()]
    assert owner.tolist() == [n for n, _ in words]
    seen = {}
    for (_, word), pair in zip(words, hashes.tolist()):
        assert seen.setdefault(word, pair) == pair
    for which in (0, 1):
        assert len({pair[which] for pair in seen.values()}) == len(seen)
    assert len(hashing.word_hashes([])[0]) == 0
