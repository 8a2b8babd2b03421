"""Registered queries against their SQL counterparts.

A cross-section runs by default; TALLYSCOPE_ALL=1 runs every query that has a counterpart.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

FOLDER = os.environ.get("TALLYSCOPE_FOLDER", "/root/testdata/sf0.001")
CROSS_SECTION = [
    "missing_dates", "historic_months", "ingest_panel_day", "fg_bg_split", "sessionize_capped", "sessionize_gap",
    "phi_correlation", "registered_domain", "cnb_params", "cnb_infer", "first_last_sessions", "zero_filled_reach",
    "mi_params", "posterior_score", "merge_sources_weighted", "share_ratio_v2", "merge_source_trends", "prior_trend",
    "engagement_imputed_daily", "historic_prior_fusion", "top_k_per_group", "signal_outer_join",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("TALLYSCOPE_ALL") else CROSS_SECTION


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    problems, _, _, _ = compare(spark, duck, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    # The smallest data leaves some results empty; that is agreement, too.
    assert [p for p in problems if p != "no rows"] == []


def test_every_counterpart_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
