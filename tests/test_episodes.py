"""Stop-memory episodes against a brute-force fixpoint on random days, in batch and over batches."""

import random
from datetime import date, timedelta

import pytest

from pitframe.operators.episodes import episodes
from pitframe.streaming import jobs

DAY0 = date(2024, 1, 1)


def fixpoint(stops, blocked, reentry, ranked):
    """Repeat until nothing changes: derive releases, open an episode at the first uncovered block."""
    days = sorted({d for _, d in ranked})
    rank = set(ranked)
    blk = {(a, d) for a, d in blocked if d in days}
    eps = {(a, d): "stop" for a, d in stops}

    def released(a, since):
        nxt = min((d for x, d in eps if x == a and d > since), default=None)
        inside = lambda d: nxt is None or d < nxt
        found = [(d, "price") for x, d in reentry if x == a and d >= since and inside(d)]
        found += [(d, "not_ranked") for d in days if d > since and inside(d) and (a, d) not in blk and (a, d) not in rank]
        return min(found, default=(None, None))

    changed = True
    while changed:
        changed = False
        for a, d in sorted(blk, key=lambda x: x[1]):
            covered = any(x == a and s <= d and (released(x, s)[0] is None or released(x, s)[0] >= d) for x, s in eps)
            if not covered:
                eps[a, d] = "decision_close"
                changed = True
                break
    return {(a, s, kind, *released(a, s)) for (a, s), kind in eps.items()}


def random_case(seed):
    rnd = random.Random(seed)
    pick = lambda p: sorted({(a, DAY0 + timedelta(d)) for a in range(1, 5) for d in range(20) if rnd.random() < p})
    days = {d for d in range(20) if rnd.random() < 0.4} or {3}
    ranked = sorted({(a, DAY0 + timedelta(d)) for a in range(1, 6) for d in days if rnd.random() < 0.6})
    return pick(0.12), pick(0.25), pick(0.15), ranked


def frames(spark, case):
    return [spark.createDataFrame(rows, "asset_id bigint, date date") for rows in case]


@pytest.mark.parametrize("seed", range(4))
def test_closed_form_equals_fixpoint(spark, seed):
    case = random_case(seed)
    got = {tuple(r) for r in episodes(*frames(spark, case)).select("asset_id", "since", "start_kind", "released", "cause").collect()}
    assert got == fixpoint(*case)


def test_batches_of_days_equal_one_batch(spark, tmp_path):
    case = random_case(11)
    each = jobs.fold_episodes(str(tmp_path))
    for batch, (lo, hi) in enumerate(((0, 6), (6, 13), (13, 20))):
        rows = [(a, d, k) for k, part in zip(("stop", "blocked", "reentry", "ranked"), case) for a, d in part if lo <= (d - DAY0).days < hi]
        df = spark.createDataFrame(rows, "asset_id bigint, date date, kind string")
        each(df, batch)
        each(df, batch)  # a repeated batch changes nothing
    got = {tuple(r) for r in jobs.episodes_so_far(spark, str(tmp_path)).select("asset_id", "since", "start_kind", "released", "cause").collect()}
    assert got == fixpoint(*case)


def test_episodes_make_no_row_per_asset_and_ranking_day(spark):
    day = "cast(date_add(date '2024-01-01', cast(id as int)) as date) AS date"
    stops = spark.range(5).selectExpr("id AS asset_id", day)
    ranked = spark.range(50).selectExpr("id % 5 AS asset_id", day)
    none = stops.limit(0)
    plan = episodes(stops, none, none, ranked)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
