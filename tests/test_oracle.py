"""Registered queries against their SQL. TIDEMARK_ORACLE=all runs every one, else a cross-section."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

SF = os.environ.get("TIDEMARK_ORACLE_SF", "/root/testdata/sf0.001")
SOME = (
    "flagship_top_leads", "a5_importance", "w7_final_rank", "f1_canonical_url", "f8_clean_text", "j1_url_duplicates", "j2_similar_titles",
    "a19_components", "a14_event_study", "j15_price_merge", "a9_rolling_week_top", "a20_gap_ranking", "v3_learn_rules", "s1_daily_scan",
    "s12_payload_repair", "w11_calendar_components", "t4_sliding_baseline", "u6_stored_vs_fresh",
)
KEYS = list(entry.queries()) if os.environ.get("TIDEMARK_ORACLE") == "all" else SOME


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_its_sql(spark, con, name):
    status, _, n, note = compare(spark, con, name, SF)
    assert status in ("ok", "rows") and n > 0, note


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
