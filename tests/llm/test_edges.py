"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import awkward
import corpus_pipeline
from tidemark.llm.byte_bpe import decode_ids, encode_texts
from tidemark.llm.decontaminate import clean_documents, contamination
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.jaccard_join import jaccard_groups, one_of_each_group
from tidemark.llm.kneser_ney import accepted_documents, quality_scores
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.line_dedup import deduplicate_lines
from tidemark.llm.rendezvous import assign_shards
from tidemark.llm.sanitise import sanitise
from tidemark.llm.token_rollup import TOKENIZERS, token_counts

BYTES = {bytes([i]): i for i in range(256)}
PER_ROW = {
    "line_dedup": lambda spark, docs: deduplicate_lines(docs),
    "token_counts": lambda spark, docs: token_counts(docs, *TOKENIZERS),
    "contamination": lambda spark, docs: contamination(docs, awkward.benchmark(spark)),
    "sanitise": lambda spark, docs: sanitise(docs),
    "exact_groups": lambda spark, docs: exact_groups(docs),
    "bpe": lambda spark, docs: decode_ids(encode_texts(docs, BYTES, r"\s|\S+"), BYTES),
    "jaccard": lambda spark, docs: jaccard_groups(docs),
    "shards": lambda spark, docs: assign_shards(docs, {0: 1.0, 1: 2.0}),
    "quality": lambda spark, docs: quality_scores(docs, awkward.labels(spark)),
}
FILTERS = {
    "accepted": lambda spark, docs: accepted_documents(docs, awkward.labels(spark)),
    "clean": lambda spark, docs: clean_documents(docs, awkward.benchmark(spark)),
    "one_of_each": lambda spark, docs: one_of_each_group(docs),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row_and_other_columns_do_not_matter(spark, name):
    result = PER_ROW[name](spark, awkward.frame(spark))
    rows = result.collect()
    assert len(rows) == len(awkward.ROWS)
    extra = PER_ROW[name](spark, awkward.frame(spark, extra=True))
    if name != "line_dedup":
        assert sorted(map(str, extra.collect())) == sorted(map(str, rows))
    else:
        assert extra.columns[-2:] == ["n_lines", "n_deleted"]
        assert sorted(str(r[1]) for r in extra.collect()) == sorted(str(r[1]) for r in rows)


@pytest.mark.parametrize("name", [*PER_ROW, *FILTERS])
def test_an_empty_table_gives_an_empty_result(spark, name):
    operator = {**PER_ROW, **FILTERS}[name]
    assert operator(spark, awkward.frame(spark, rows=())).collect() == []


@pytest.mark.parametrize("name", FILTERS)
@pytest.mark.parametrize("extra", (False, True))
def test_filters_return_rows_as_they_are(spark, name, extra):
    docs = awkward.frame(spark, extra=extra)
    result = FILTERS[name](spark, docs)
    assert result.columns == docs.columns
    assert {str(r) for r in result.collect()} <= {str(r) for r in docs.collect()}


def test_licenses_of_awkward_rows(spark):
    assert scan_licenses(awkward.frame(spark, extra=True)).collect() == []
    assert scan_licenses(awkward.frame(spark, rows=())).collect() == []


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    awkward.labels(spark).write.parquet(f"{folder}/labels.parquet")
    awkward.benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_pipeline_stages(spark, tables, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    last = name == corpus_pipeline.STAGES[-1][0]
    for rows in (awkward.ROWS, ()):
        docs = awkward.frame(spark, rows=rows, extra=True)
        result = stage(spark, docs, tables)
        assert last or result.columns == docs.columns
        assert result.count() <= len(rows)


def test_an_unknown_column_is_named(spark):
    with pytest.raises(ValueError, match="body"):
        exact_groups(awkward.frame(spark), text_column="body")
