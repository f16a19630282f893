"""Source views derived from the given tables, so that projections and questions grow with them.

Customers play assets, orders play alerts, cycles and filings, line items play daily weights; a
book is one (year, priority). The SQL is plain enough for Spark and for the checking engine, so both
start from the same rows. Tables are written ``{orders}``.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "supplier", "orders", "lineitem", "events", "documents", "nation", "region", "part")

VIEWS: dict[str, str] = {
    "base": """
        SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderstatus AS st,
          CAST(o_totalprice AS DECIMAL(18,2)) AS price, 'P' || (year(o_orderdate) - 1990) AS win, CAST(substr(o_orderpriority, 1, 1) AS INT) AS a,
          (year(o_orderdate) - 1990) * 10 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS book_id, year(o_orderdate) - 1990 AS run_id,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'MARKOWITZ_BASE' WHEN '2' THEN 'TOPN_MV_NOGUARD' WHEN '3' THEN 'TOPN_MV_GUARD' WHEN '4' THEN 'TOPN_MV_GUARD_NO_NLP' ELSE 'MARKOWITZ_BASE_GUARD' END AS arm,
          CASE o_orderkey % 6 WHEN 0 THEN 'L0_CARTERA_ACTIVATION' WHEN 1 THEN 'L0_CARTERA_RECOVERY' WHEN 2 THEN 'L0_CARTERA_SCALE_CHANGE' WHEN 3 THEN 'L1_BP_REENTRY' WHEN 4 THEN 'L1_BP_STOP' ELSE 'L1_BP_STOP_BLOCKED' END AS rule_id
        FROM {orders}""",
    "v_book": """
        SELECT CAST(book_id AS BIGINT) AS book_id, CAST(run_id AS BIGINT) AS backtest_run_id, win AS window_id, min(d) AS d_start, max(d) AS d_end, min(d) AS formation_date, 'completed' AS run_status,
          arm AS arm_code, 'min_variance' AS objective, CAST(a % 2 AS BIGINT) AS exclude_hard_vetoed, CASE WHEN a > 2 THEN '0,1' END AS guard_layers, 'v1' AS code_version, max(d) AS knowledge_date
        FROM base GROUP BY book_id, run_id, win, arm, a""",
    "v_book_rebalance": """
        SELECT CAST(book_id * 100 + m AS BIGINT) AS rebalance_id, CAST(book_id AS BIGINT) AS book_id, CAST(run_id AS BIGINT) AS backtest_run_id, arm AS arm_code, min(d) AS decision_date, CAST(min(d) + INTERVAL 1 DAY AS DATE) AS execution_date,
          CAST(NULL AS BIGINT) AS quant_portfolio_id, CASE WHEN m > 2 THEN CAST(y * 100 + m AS BIGINT) END AS cycle_run_id, CAST(NULL AS BIGINT) AS risk_model_id, 'EXECUTED' AS status, max(d) AS knowledge_date
        FROM base GROUP BY book_id, run_id, arm, y, m""",
    "v_guard_alert": """
        SELECT CAST(k AS BIGINT) AS alert_id, CAST(run_id AS BIGINT) AS backtest_run_id, win AS window_id, d AS date, CAST(substr(rule_id, 2, 1) AS BIGINT) AS layer, CASE WHEN k % 6 > 2 THEN 'T' || c END AS ticker, CASE WHEN k % 6 > 2 THEN CAST(c AS BIGINT) END AS asset_id, rule_id,
          CAST(price * 0.001 AS DECIMAL(18,5)) AS value, CAST(100 AS DECIMAL(18,2)) AS threshold, CASE WHEN k % 5 = 0 THEN 'EXIT' ELSE 'ENTER' END AS state, d AS knowledge_date
        FROM base WHERE st <> 'P'""",
    "v_guard_action": """
        SELECT CAST(k AS BIGINT) AS action_id, CAST(book_id AS BIGINT) AS book_id, CAST(run_id AS BIGINT) AS backtest_run_id, arm AS arm_code, CAST(k AS BIGINT) AS alert_id, d AS decision_date, CAST(d + INTERVAL 1 DAY AS DATE) AS effective_date, CASE WHEN k % 6 > 2 THEN 'T' || c END AS ticker, CASE WHEN k % 6 > 2 THEN CAST(c AS BIGINT) END AS asset_id,
          CASE WHEN k % 7 = 0 THEN 'ARM_DISABLED' WHEN k % 7 = 1 THEN 'BLOCKED' ELSE 'APPLIED' END AS status, CASE WHEN k % 6 > 2 THEN CAST(price * 0.000001 AS DECIMAL(18,8)) END AS weight_before, CASE WHEN k % 6 = 4 THEN CAST(0 AS DECIMAL(18,8)) END AS weight_after, d AS knowledge_date
        FROM base WHERE st = 'F'""",
    "held": """
        SELECT CAST(b.book_id AS BIGINT) AS book_id, CAST(b.run_id AS BIGINT) AS backtest_run_id, b.arm AS arm_code, b.win AS window_id, b.d AS date, l_suppkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, count(*) AS n
        FROM {lineitem} JOIN base b ON b.k = l_orderkey GROUP BY 1, 2, 3, 4, 5, 6""",
    "v_book_weight_daily": """
        SELECT book_id, backtest_run_id, arm_code, date, 'T' || l_suppkey AS holding_key, CAST(l_suppkey AS BIGINT) AS asset_id, 'Holding ' || l_suppkey AS holding_name, CASE WHEN l_suppkey % 3 > 0 THEN CAST(q * 0.0001 AS DECIMAL(18,6)) END AS markowitz_target_weight, CAST(CASE WHEN n > 3 THEN 0 ELSE q * 0.0001 END AS DECIMAL(18,6)) AS final_target_weight, date AS knowledge_date FROM held
        UNION ALL SELECT book_id, backtest_run_id, arm_code, date, 'CASH', CAST(NULL AS BIGINT), NULL, CAST(NULL AS DECIMAL(18,6)), CAST(sum(n) * 0.001 AS DECIMAL(18,6)), date FROM held GROUP BY 1, 2, 3, 4""",
    "v_book_daily_performance": """
        SELECT CAST(book_id AS BIGINT) AS book_id, CAST(run_id AS BIGINT) AS backtest_run_id, arm AS arm_code, win AS window_id, d AS date, CAST(sum(price) * 0.00000001 AS DECIMAL(18,8)) AS gross_return, CAST(count(*) * 0.01 AS DECIMAL(18,8)) AS turnover, CAST(count(*) * 0.0001 AS DECIMAL(18,8)) AS cost_return,
          CAST(sum(price) * 0.00000001 - count(*) * 0.0001 AS DECIMAL(18,8)) AS net_return, CAST(1 + max(price) * 0.000001 AS DECIMAL(18,8)) AS nav, CAST(0 - min(price) * 0.000001 AS DECIMAL(18,8)) AS drawdown, CAST(0.1 AS DECIMAL(18,8)) AS cash_weight, CAST(count(DISTINCT c) AS BIGINT) AS n_equity, CAST(NULL AS DECIMAL(18,8)) AS benchmark_return, d AS knowledge_date
        FROM base GROUP BY book_id, run_id, arm, win, d""",
    "seg": """
        SELECT *, win AS segment FROM base UNION ALL SELECT *, win || CASE WHEN m <= 6 THEN 'a' ELSE 'b' END FROM base""",
    "v_portfolio_period_summary": """
        SELECT CAST(book_id AS BIGINT) AS book_id, CAST(run_id AS BIGINT) AS backtest_run_id, arm AS arm_code, win AS window_id, segment, min(d) AS date_from, max(d) AS date_to, CAST(sum(price) * 0.000000001 AS DECIMAL(18,8)) AS cumulative_return, CAST(max(price) * 0.000001 AS DECIMAL(18,8)) AS annualized_return, CAST(min(price) * 0.000001 AS DECIMAL(18,8)) AS annualized_vol,
          CAST(count(*) * 0.01 AS DECIMAL(18,8)) AS ex_post_sharpe, CAST(0 - max(price) * 0.000001 AS DECIMAL(18,8)) AS max_drawdown, CAST(count(DISTINCT c) * 0.01 AS DECIMAL(18,8)) AS total_turnover, CAST(count(*) * 0.1 AS DECIMAL(18,8)) AS total_cost_bps, CAST(count(DISTINCT m) AS BIGINT) AS n_rebalances,
          CAST(sum(CASE WHEN st = 'F' AND k % 7 > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_guard_actions, max(d) AS knowledge_date FROM seg GROUP BY book_id, run_id, arm, win, segment""",
    "v_backtest_test": """
        SELECT a.backtest_run_id, a.window_id, a.segment, a.arm_code AS arm_a, b.arm_code AS arm_b, 'paired_t' AS test, CAST(a.cumulative_return - b.cumulative_return AS DECIMAL(18,8)) AS statistic, CAST(0.05 AS DECIMAL(18,8)) AS p_value, a.n_rebalances + b.n_rebalances AS n_obs, CAST(NULL AS STRING) AS params_json, a.knowledge_date
        FROM v_portfolio_period_summary a JOIN v_portfolio_period_summary b ON b.window_id = a.window_id AND b.segment = a.segment WHERE b.arm_code = 'MARKOWITZ_BASE' AND a.arm_code <> 'MARKOWITZ_BASE'""",
    "v_cycle_run": """
        SELECT CAST(y * 100 + m AS BIGINT) AS run_id, 'REPLAY' AS cycle_type, min(d) AS as_of, 'v1' AS code_version, CASE WHEN m = 12 THEN 'failed' ELSE 'completed' END AS status, CAST(min(d) AS TIMESTAMP) AS started_at, CAST(max(d) AS TIMESTAMP) AS finished_at, CAST(NULL AS STRING) AS params_json, 'P' || (y - 1990) AS window_id FROM base GROUP BY y, m""",
    "v_weight_scheme": """
        SELECT run_id AS cycle_run_id, cycle_type, as_of AS cycle_date, 'score_tilt' AS scheme_id, CAST(NULL AS STRING) AS weights_json, CAST(10 AS BIGINT) AS top_n, CAST(0.1 AS DECIMAL(18,8)) AS max_name_weight, CAST(0.3 AS DECIMAL(18,8)) AS max_sector_weight, CAST(NULL AS DECIMAL(18,8)) AS soft_veto_penalty, window_id FROM v_cycle_run""",
    "v_weight_component": """
        SELECT cycle_run_id, cycle_type, cycle_date, 'FUNDAMENTAL' AS score_type, CAST(0.6 AS DECIMAL(18,8)) AS weight FROM v_weight_scheme UNION ALL SELECT cycle_run_id, cycle_type, cycle_date, 'TECHNICAL', CAST(0.4 AS DECIMAL(18,8)) FROM v_weight_scheme""",
    "v_cycle_ranking": """
        SELECT *, CASE WHEN rank <= 10 THEN 1 ELSE 0 END AS selected, CASE WHEN rank <= 10 THEN CAST(0.1 AS DECIMAL(18,8)) END AS target_weight FROM (
          SELECT CAST(y * 100 + m AS BIGINT) AS cycle_run_id, 'REPLAY' AS cycle_type, win AS window_id, 'T' || c AS ticker, CAST(c AS BIGINT) AS asset_id, CAST(1 + min(k) % 200 AS BIGINT) AS rank, CAST(least(100, sum(price) * 0.0001) AS DECIMAL(18,8)) AS blended_score,
            CASE WHEN max(k) % 9 = 0 THEN 1 ELSE 0 END AS vetoed, CASE WHEN max(k) % 9 = 0 THEN '["HARD_2"]' END AS veto_rules_json, 'ranked' AS status FROM base GROUP BY y, m, win, c) r""",
    "v_cycle_ranking_component": """
        SELECT cycle_run_id, asset_id, 'FUNDAMENTAL' AS score_type, CAST(blended_score AS DECIMAL(18,8)) AS component_value, CAST(0.6 AS DECIMAL(18,8)) AS configured_weight, CAST(0.6 AS DECIMAL(18,8)) AS effective_weight FROM v_cycle_ranking WHERE asset_id % 4 > 0
        UNION ALL SELECT cycle_run_id, asset_id, 'TECHNICAL', CAST(50 AS DECIMAL(18,8)), CAST(0.4 AS DECIMAL(18,8)), CAST(0.4 AS DECIMAL(18,8)) FROM v_cycle_ranking""",
    "ships": "SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS ship FROM {lineitem} GROUP BY 1",
    "v_veto": """
        SELECT CAST(k AS BIGINT) AS id, 'T' || c AS ticker, CAST(c AS BIGINT) AS asset_id, 'HARD_' || a AS rule_id, CASE WHEN a < 3 THEN 'HARD' ELSE 'SOFT' END AS severity, d AS raised_on, CASE WHEN ship > d THEN ship END AS cleared_on, CASE WHEN k % 3 = 0 THEN d END AS last_seen_on, CAST(NULL AS DATE) AS expires_on, CAST(y * 100 + m AS BIGINT) AS run_id, win AS window_id
        FROM base LEFT JOIN ships ON l_orderkey = k WHERE st = 'P'""",
    "rules": """
        SELECT DISTINCT rule_id, 'R_' || rule_id AS rule_iri, 'GUARD' AS category, CAST(substr(rule_id, 2, 1) AS INT) AS guard_layer, 'note of ' || rule_id AS note, DATE '1990-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to FROM base
        UNION ALL SELECT DISTINCT 'HARD_' || a, 'R_HARD_' || a || '_old', 'FINANCIAL', CAST(NULL AS INT), 'old', DATE '1990-01-01', DATE '1996-01-01' FROM base
        UNION ALL SELECT DISTINCT 'HARD_' || a, 'R_HARD_' || a, 'FINANCIAL', CAST(NULL AS INT), 'new', DATE '1996-01-01', CAST(NULL AS DATE) FROM base""",
    "assets": """
        SELECT 'T' || c_custkey AS asset, 'T' || c_custkey AS asset_symbol, 'K' || (c_custkey % 400) AS asset_cik, c_name AS company_name, CASE WHEN c_custkey % 10 <> 7 THEN c_mktsegment END AS industry, c_custkey % 50 = 1 AS is_fund, CAST(c_custkey AS BIGINT) AS asset_id, c_custkey % 33 = 0 AS masked FROM {customer} WHERE c_custkey % 13 <> 5""",
    "industries": "SELECT DISTINCT c_mktsegment AS industry, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Financials' ELSE 'Industrials' END AS sector FROM {customer}",
    "filings": """
        SELECT CAST(c * 1000 + (y - 1990) * 10 + CASE WHEN m <= 3 THEN 1 WHEN m <= 6 THEN 2 WHEN m <= 9 THEN 3 ELSE 4 END AS BIGINT) AS filing_id, CAST(c AS BIGINT) AS asset_id, 'T' || c AS ticker, 'K' || (c % 400) AS cik, CASE WHEN m > 9 THEN '10-K' ELSE '10-Q' END AS form, y AS fiscal_year, 'Q' || CASE WHEN m <= 3 THEN 1 WHEN m <= 6 THEN 2 WHEN m <= 9 THEN 3 ELSE 4 END AS fiscal_period,
          min(d) AS period_end, max(d) AS filing_date, CAST(max(d) + INTERVAL 2 DAY AS DATE) AS available_at, 'ACC-' || min(k) AS accession_number, CAST(CASE WHEN min(k) % 4 > 0 THEN max(price) * 0.0000005 END AS DECIMAL(18,8)) AS roic, CAST(CASE WHEN min(k) % 5 > 0 THEN min(price) * 0.00001 END AS DECIMAL(18,8)) AS debt, min(k) AS mk
        FROM base WHERE c % 13 <> 5 GROUP BY c, y, 7, 1, 5""",
    "metrics": """
        SELECT filing_id * 10 + 1 AS metric_id, filing_id, 'profitability' AS metric_group, 'return_on_invested_capital' AS metric_name, roic AS value, CAST(filing_date AS STRING) || 'T00:00:00Z' AS computed_at, available_at FROM filings
        UNION ALL SELECT filing_id * 10 + 2, filing_id, 'leverage', 'debt_to_equity', debt, CAST(filing_date AS STRING) || 'T08:00:00Z', available_at FROM filings
        UNION ALL SELECT filing_id * 10 + 3, filing_id, 'valuation', 'value_inputs', debt, CAST(period_end AS STRING) || 'T00:00:00Z', available_at FROM filings""",
    "assessments": """
        SELECT filing_id + 5 AS snapshot_id, asset_id, filing_id, ticker, CAST(mk % 100 AS DECIMAL(18,2)) AS score_raw_0_100, CASE WHEN mk % 100 > 60 THEN 'STRONG' ELSE 'WEAK' END AS rating, 'text of ' || mk AS narrative, 'm1' AS model, CAST(available_at AS TIMESTAMP) AS computed_at, period_end AS event_time, available_at, mk % 3 = 0 AS generated_by_language_model, 'note' AS provenance_note FROM filings WHERE mk % 7 > 2""",
    "mask": "SELECT ticker, max(asset_id) AS asset_id FROM filings WHERE asset_id % 33 = 0 GROUP BY 1",
    "stops": """
        SELECT k, CAST(book_id AS BIGINT) AS book_id, win, arm, d AS date, CAST(c AS BIGINT) AS asset_id, CAST(price * 0.000001 AS DECIMAL(18,8)) AS weight_before, CASE WHEN k % 5 = 0 THEN 'AGENT' ELSE 'RULE' END AS chooser, k % 4 = 0 AS cash, k % 10 = 2 AS spy, CAST(k % 100 AS BIGINT) AS chosen_id,
          CASE WHEN k % 4 = 0 THEN CASE k % 3 WHEN 0 THEN 'FILTER_OFF' WHEN 1 THEN 'NO_SIGNAL' ELSE 'SCALE_BELOW_ONE' END END AS cause FROM base WHERE rule_id = 'L1_BP_STOP' AND st <> 'P'""",
    "purchases": "SELECT k, book_id, win, date AS order_date, CAST(date + INTERVAL 1 DAY AS DATE) AS execution_date, asset_id AS sold_id, chosen_id AS asset_id, weight_before AS weight, k % 20 AS rank FROM stops WHERE NOT cash AND NOT spy",
    "memories": "SELECT k, book_id, win, asset_id, date AS since, CASE WHEN k % 9 = 0 THEN 'decision_close' ELSE 'stop' END AS start_kind, CASE WHEN k % 3 > 0 THEN CAST(date + INTERVAL 40 DAY AS DATE) END AS released, CASE WHEN k % 3 = 1 THEN 'price' WHEN k % 3 = 2 THEN 'not_ranked' END AS cause FROM stops",
    "decisions": "SELECT CAST(b.book_id AS BIGINT) AS book_id, b.win, r.decision_date AS date, min(b.k) AS k, CAST(0.5 + 0.5 * (min(b.k) % 2) AS DECIMAL(18,8)) AS scale FROM base b JOIN v_book_rebalance r ON r.book_id = b.book_id AND r.decision_date = b.d GROUP BY 1, 2, 3",
    "retained": "SELECT d.book_id, d.win, d.date, CAST(b.c AS BIGINT) AS asset_id, CAST(min(b.k) % 3 + 1 AS BIGINT) AS counter, min(b.k) % 2 = 0 AS kept, CASE WHEN min(b.k) % 2 = 1 THEN CASE WHEN min(b.k) % 4 = 1 THEN 'hard_veto' ELSE 'counter' END END AS cause FROM decisions d JOIN base b ON b.book_id = d.book_id AND b.d = d.date GROUP BY 1, 2, 3, 4",
    "trend": "SELECT win AS \"window\", date AS decision_date, CASE WHEN min(k) % 3 = 0 THEN 'below' ELSE 'above' END AS spy_vs_sma210, min(k) % 5 = 0 AS news_risk_off, CAST(CASE WHEN min(k) % 3 = 0 OR min(k) % 5 = 0 THEN 0.5 ELSE 0 END AS DECIMAL(18,8)) AS cash_fraction FROM decisions WHERE book_id % 10 = 1 GROUP BY 1, 2",
    "reference_returns": "SELECT window_id AS \"window\", segment, date_from, date_to, n_rebalances AS n_sessions, CASE WHEN arm_code = 'MARKOWITZ_BASE' THEN 'SPY' ELSE 'SP500_EW' END AS reference, cumulative_return AS total_return, max_drawdown FROM v_portfolio_period_summary WHERE arm_code IN ('MARKOWITZ_BASE', 'TOPN_MV_GUARD')",
    "stints": """
        SELECT 'T' || c AS symbol, 'Security ' || c AS security, 'S' AS gics_sector, CASE WHEN c % 10 <> 7 THEN 'SUB' || (c % 5) END AS gics_sub_industry, CASE WHEN c % 6 > 0 THEN 'K' || CAST(floor(c / 3) AS BIGINT) END AS cik, min(d) AS valid_from, CASE WHEN max(d) < DATE '2000-06-01' THEN max(d) END AS valid_to FROM base GROUP BY c, y % 2""",
}
_NAME = re.compile(r"(?:FROM|JOIN)\s+(\w+)")


def _needs(name: str, seen: list[str], given: Collection[str] = ()) -> list[str]:
    for dep in _NAME.findall(VIEWS[name]):
        if dep in VIEWS and dep not in seen and dep not in given:
            _needs(dep, seen, given)
    if name not in seen:
        seen.append(name)
    return seen


def with_clause(*names: str, given: Collection[str] = ()) -> str:
    """``WITH`` clause defining views and all they need but the given ones, tables still as placeholders."""
    order: list[str] = []
    for n in names:
        _needs(n, order, given)
    return ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)


def check_sql(names: str, body: str, recursive: bool = False) -> str:
    """SQL for the checking engine: the named views, then ``body``."""
    text = f"WITH {'RECURSIVE ' if recursive else ''}{with_clause(*names.split())} {body}"
    return re.sub(r"\{(\w+)\}", r"\1", text)


def view(spark: SparkSession, sf_dir: str, name: str, given: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A derived view as a DataFrame; the given tables are scanned where the view names them.

    ``given``: views that are derived already, read as they are.
    """
    given = given or {}
    text = f"WITH {with_clause(name, given=given)} SELECT * FROM {name}".replace('"window"', "`window`")
    text = _NAME.sub(lambda m: m[0].replace(m[1], "{" + m[1] + "}") if m[1] in given else m[0], text)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    used |= {v: df for v, df in given.items() if "{" + v + "}" in text}
    return spark.sql(text, **used)
