"""Bound queries against their SQL counterparts on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from linkloom import bindings  # noqa: E402

SF = "/root/testdata/sf0.001"
CHECKED = (
    "fact_consolidate", "update_join_layered", "upsert_last_wins", "topx_classes", "concat_values", "clean_places",
    "graph_edges", "components", "burt_constraint", "person_fuzzy_ids", "truth_summary", "shred_usreldoc", "stream_counts",
)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    text, good = compare.compare(spark, compare.duck(SF), SF, name, bindings.queries()[name], bindings.oracles()[name])
    assert good, text


def test_every_counterpart_has_a_query():
    assert set(bindings.oracles()) <= set(bindings.queries())
