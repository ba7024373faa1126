"""A spread of registered queries against their SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

from scholion.plans import registry

SF = "/root/testdata/sf0.001"
NAMES = ["normalize_raw", "flatten_corpus", "section_spans", "human_chunks", "main_signal_tasks", "header_path_chunks",
         "paper_context_v1", "extract_doi", "anchor_terms_prop", "family_terms_char", "label_lines_char", "build_windows_char",
         "build_windows_prop", "rank_windows_prop", "proc_tasks", "char_tasks", "parse_responses", "number_identities",
         "merge_process_steps", "exact_pairs", "predict"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, registry.queries()[name], registry.oracles()[name], SF)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(registry.oracles()) <= set(registry.queries())
