"""A spread of registered queries against their SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, oracle

SF = "/root/testdata/sf0.001"
NAMES = ["redact_documents", "pii_digit_runs", "span_islands", "text_scan", "redacted_files", "stream_records",
         "shard_contiguous", "split_ratio", "bleu_4", "rouge_l", "vocab_build", "causal_samples", "tag_segments",
         "lexicon_join", "fuzzy_terms", "neg_relations", "augment_insert", "telemetry_rollup", "group_advantage"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, oracle(SF, entry.oracle_sql()[name])) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
