import random

from tests.llm.helpers import components as plain
from tierlake.llm.common import Scratch, configure
from tierlake.llm.components import components


def check(spark, pairs):
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in components(frame, Scratch(configure(spark))).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == plain(nodes, [p for p in pairs if p[0] != p[1]])


def test_random_graph(spark):
    draw = random.Random(5)
    check(spark, [(draw.randrange(400), draw.randrange(400)) for _ in range(260)])


def test_long_chain_and_hub(spark):
    names = list(range(200))
    random.Random(6).shuffle(names)
    chain = list(zip(names, names[1:]))
    hub = [(1000, n) for n in range(1001, 1400)]
    check(spark, chain + hub + [(7, 7), (1000, 1001)])


def test_no_edges(spark):
    check(spark, [])
