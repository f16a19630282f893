"""Registered queries against their SQL on the smallest tables.

One query of every module by default; ``PITFRAME_ALL=1`` runs all of them.
"""

import os
from pathlib import Path

import duckdb
import pytest

from pitframe.catalog import load

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = load()
SAMPLE = (
    "asof_latest_require asof_join asof_join_ties overlaps with_previous next_event interval members_per_quarter classify_lines link_entity assert_fk set_diff melt pivot_class bgp closure cycles "
    "validate_shapes shape_pairs plan_batch refused_closures restatement_problems row_failures cascade visibility contract_diff weighted_profile segment_identity severity episodes memory_control "
    "compare_controls ent_alerts ent_fundamentals ent_stops c1_quality_at_stop c14_retained_names q_latest_nav stream_tumbling_counts stream_episodes stream_ingest stream_late scan_jsonl scan_json_doc append_graph delivery_boundary load_orphan_refused gate_unreadable_dates later_summary boundary_cap boundary_stopped delivery_differences stream_repeated_keys taken_ids_indexed ent_formation ent_purchases"
).split()
NAMES = sorted(QUERIES) if os.environ.get("PITFRAME_ALL") else [n for n in SAMPLE if n in QUERIES]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.skipif(not SF.exists(), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    rel = duck.sql(SQL[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want, list(rel.columns))
