"""Staged tables and their end."""

import uuid
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.helpers import SF_DIR
from tierlake.llm import common, simhash
from tierlake.llm.common import Scratch, configure, staging


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """A shared folder of its own."""
    configure(spark)
    monkeypatch.setattr(common, "scratch_dir", lambda spark, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}")
    return tmp_path


def names(folder):
    return sorted(path.name.rpartition("-")[0] for path in Path(folder).iterdir())


def test_staged_tables_go_with_the_block(spark, shared):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lasting = Scratch(spark, lasting=True)
    with staging(spark):
        kept = lasting.write(simhash.one_per_group(docs), "kept")
        assert len(names(shared)) > 1
    assert names(shared) == ["kept"] and kept.count() > 0
    with pytest.raises(ZeroDivisionError), staging(spark):
        Scratch(spark).write(docs, "lost")
        raise ZeroDivisionError
    assert names(shared) == ["kept"]
    Scratch(spark).write(docs, "outside")
    assert names(shared) == ["kept", "outside"]


def test_pipeline_keeps_what_its_result_reads(spark, shared):
    found = corpus_pipeline.run(spark, SF_DIR)
    left = names(shared)
    assert "mix-sources" not in left and "quality-rules" not in left and "measured" not in left
    assert found.count() > 0
