"""Columns of the caller, whatever their names, change no result and come back unchanged."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from tests.compare import spark_rows
from tests.llm.helpers import SF_DIR
from tierlake.llm import (
    audit, caps, chat, codes, extract, mixing, packing, quality, secrets, simhash, substrings, toxicity, urls)
from tierlake.llm.common import configure, read
from tierlake.llm.queries import packed, secret_model, square_root_targets

SOURCES = Path(quality.__file__).parent


def internal_names():
    """Every quoted word in the package that could name a column, and all that are put together."""
    found = set()
    for file in SOURCES.glob("*.py"):
        if file.name == "html_samples.py":
            continue
        text = file.read_text()
        found |= set(re.findall(r"""["'`]([A-Za-z_][A-Za-z0-9_]{0,30})["'`]""", text))
        found |= set(re.findall(r"(\w+) (?:long|int|string|double|boolean|binary|array)\b", text))
    found |= {f"_{rule}" for rule in quality.RULES} | {f"c{i}" for i in range(12)}
    found |= {f"_{name}_{x}" for name in ("assign", "access", "hex", "candidates") for x in ("found", "gaps", "lens", "sums")}
    return sorted({name.lower(): name for name in found if name.isidentifier()}.values())


def with_names(df):
    """``df`` with a column of each internal name that it has not, and those names."""
    have = {c.lower() for c in df.columns}
    added = [name for name in internal_names() if name.lower() not in have]
    return df.selectExpr("*", *[f"{i} AS `{name}`" for i, name in enumerate(added)]), added


def compared(run, frame):
    plain = run(frame)
    wide, added = with_names(frame)
    assert len(added) > 150
    found = run(wide)
    assert spark_rows(found.select(*plain.columns)) == spark_rows(plain)
    return found, added


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 80 AND length(text) < 20000")


@pytest.fixture(scope="module")
def labels(spark):
    return read(spark, SF_DIR, "labels", "doc_id", "quality", "toxic")


@pytest.fixture(scope="module")
def model(spark, docs):
    return secret_model(spark, docs)


def test_keeping_good_documents(spark, docs, labels):
    found, added = compared(lambda d: quality.keep(d, labels), docs)
    assert set(added) <= set(found.columns) and [r[0] for r in found.select(added[7]).distinct().collect()] == [7]


def test_one_document_per_group(spark, docs):
    found, added = compared(simhash.one_per_group, docs)
    assert set(added) <= set(found.columns) and [r[0] for r in found.select(added[9]).distinct().collect()] == [9]


def test_redaction(spark, docs, model):
    found, added = compared(lambda d: secrets.redact(d, model), docs)
    values = found.select(*added).distinct().collect()
    assert [tuple(r) for r in values] == [tuple(range(len(added)))]


def test_scan(spark, docs, model):
    found, added = compared(lambda d: secrets.scan(d, model).select("doc_id", "secret_spans"), docs)


def test_mixing(spark, docs):
    targets = square_root_targets(docs)
    found, added = compared(lambda d: mixing.repeat(d, targets, "n_chars"), docs)
    values = found.select(*added).distinct().collect()
    assert [tuple(r) for r in values] == [tuple(range(len(added)))]
    compared(lambda d: mixing.mix(d, targets, "n_chars").select("doc_id", "copy", "rate", "order_key"), docs)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stage(spark, docs, name):
    """A stage returns the columns it was given, with the caller's values."""
    stage = dict(corpus_pipeline.STAGES)[name]
    found, added = compared(lambda d: stage(spark, d, SF_DIR), docs)
    assert found.columns == [*docs.columns, *added]
    values = found.select(*added).distinct().collect()
    assert [tuple(r) for r in values] == [tuple(range(len(added)))]


@pytest.mark.parametrize("run", [
    simhash.near_duplicates, lambda d: substrings.repeated_spans(d).drop("removed"), packed,
], ids=["simhash", "substrings", "packing"])
def test_operators_on_documents(spark, docs, run):
    compared(run, docs)


def test_rest_of_the_operators_on_documents(spark, docs, labels, model):
    compared(lambda d: secrets.report(d, model), docs)
    compared(lambda d: audit.interactions(audit.postings(d, with_names(labels)[0])), docs)
    compared(lambda d: toxicity.score(d, toxicity.train(d, with_names(labels)[0])).select("doc_id", "score", "predicted"), docs)
    compared(lambda d: quality.judge(quality.measure(d), quality.calibrate(quality.measure(d), labels)).select("doc_id", "kept"), docs)


def test_operators_on_other_tables(spark):
    pages = read(spark, SF_DIR, "pages", "page_id", "url", "html").limit(30)
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    compared(extract.extract, pages)
    compared(lambda p: urls.judge(p, with_names(rules)[0]), pages)
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").limit(100)
    compared(caps.near_duplicates, vectors.select("vec_id", "embedding"))
    compared(codes.compress, vectors)
    talks = spark.read.parquet(f"{SF_DIR}/conversations.parquet").where("conv_id < 20")
    compared(lambda c: chat.digests(chat.format_turns(c)), talks)
