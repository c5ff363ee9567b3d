"""Registered queries against their SQL on the smallest tables.

The quick ones; `python -m checks.compare` runs all of them.
"""

import os

import pytest

from checks import compare, oracle, registry

SF = "/root/testdata/sf0.001"
QUICK = [
    "dedupe_latest", "duplicate_report", "remap_units", "mart_full", "heatmap_special", "condition_summary",
    "day_category_effect_fanout", "streak_effect", "combined_effect", "tier_recommend", "strategy_recommend",
    "strategy_recommend_literal", "best_method", "collection_days", "mart_status", "fallback_merge", "apply_changes",
    "parse_tsv", "layout_documents",
]


def test_every_sql_has_a_query():
    assert set(oracle.build()) <= set(registry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in compare.TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    cur = con.execute(oracle.build()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert compare.rows_of(df.columns, [tuple(r) for r in df.collect()]) == compare.rows_of(cols, cur.fetchall())
