"""Mappings of the projected classes: column, kind, and where it differs the property name.

Fixed values: property names, link directions and closed kinds. A property named like its column in
camel case is not spelled out.
"""

from __future__ import annotations

from pitframe.operators.quads import ClassMap, class_map

BOOK = class_map("StrategyBook", """
    book_id integer !
    backtest_run_id integer !
    run_label string !
    window_id string !
    d_start date as=backtestStartDate !
    d_end date as=backtestEndDate !
    run_status string !
    arm_code string !
    objective string !
    exclude_hard_vetoed boolean !
    guard_layers string
    configuration iri
    formation_date date
    code_version string
    knowledge_date date !
""")
ALERT = class_map("GuardAlert", """
    alert_id integer !
    backtest_run_id integer !
    window_id string !
    date date as=alertDate !
    layer integer as=guardLayer !
    rule_iri iri as=alertRule !
    ticker string as=guardTicker
    asset iri as=guardAsset
    value decimal as=alertValue
    threshold decimal as=alertThreshold
    state string as=alertState !
    knowledge_date date !
""")
REBALANCE = class_map("BookRebalance", """
    rebalance_id integer !
    book_id integer !
    backtest_run_id integer !
    arm_code string !
    decision_date date !
    execution_date date !
    quant_portfolio_id integer
    cycle_run_id integer
    risk_model_id integer
    status string !
    book iri as=rebalanceOfBook inverse=bookHasRebalance !
    knowledge_date date !
""")
ACTION = class_map("GuardAction", """
    action_id integer !
    book_id integer !
    backtest_run_id integer !
    arm_code string !
    decision_date date !
    effective_date date !
    status string !
    book iri as=actionOfBook inverse=bookHasGuardAction !
    alert iri as=actionAlert inverse=alertHasGuardAction !
    ticker string as=guardTicker
    asset iri as=guardAsset
    weight_before decimal
    weight_after decimal
    knowledge_date date !
""")
WEIGHT = class_map("BookWeightDaily", """
    book_id integer !
    backtest_run_id integer !
    arm_code string !
    date date as=weightDate !
    holding_key string !
    asset iri as=holdingAsset
    holding_name string
    markowitz_target_weight decimal
    final_target_weight decimal
    book iri as=weightOfBook inverse=bookHasWeight !
    knowledge_date date !
""")
PERFORMANCE = class_map("BookDailyPerformance", """
    book_id integer !
    backtest_run_id integer !
    arm_code string !
    window_id string !
    date date as=performanceDate !
    gross_return decimal !
    turnover decimal !
    cost_return decimal !
    net_return decimal !
    nav decimal !
    drawdown decimal !
    cash_weight decimal !
    n_equity integer !
    benchmark_return decimal
    book iri as=performanceOfBook inverse=bookHasPerformance !
    knowledge_date date !
""")
SUMMARY = class_map("PortfolioPeriodSummary", """
    book_id integer !
    backtest_run_id integer !
    arm_code string !
    window_id string !
    segment string !
    date_from date !
    date_to date !
    cumulative_return decimal !
    annualized_return decimal !
    annualized_vol decimal !
    ex_post_sharpe decimal !
    max_drawdown decimal !
    total_turnover decimal !
    total_cost_bps decimal !
    n_rebalances integer !
    n_guard_actions integer !
    book iri as=summaryOfBook inverse=bookHasSummary !
    knowledge_date date !
""")
TEST = class_map("BacktestTest", """
    backtest_run_id integer !
    run_label string !
    window_id string !
    segment string !
    arm_a string !
    arm_b string !
    test string as=testName !
    statistic decimal !
    p_value decimal !
    n_obs integer !
    params_json string
    knowledge_date date !
""")
CYCLE = class_map("SelectionCycle", """
    run_id integer as=cycleRunId !
    cycle_type string !
    as_of date as=runAsOf !
    run_text string as=runId !
    status string !
    run_label string !
    window_id string !
    backtest_run_id integer !
    code_version string
    started_at dateTime
    finished_at dateTime
""")
SCHEME = class_map("AttractivenessWeightScheme", """
    run_text string as=schemeId !
    cycle_date date !
    cycle_run_id integer !
    run_text string as=runId !
    scheme_id string as=bookWeightingRule !
    top_n integer !
    max_name_weight decimal
    max_sector_weight decimal
    soft_veto_penalty decimal
    component iri as=hasWeightComponent many
""")
CONFIGURED = class_map("WeightComponent", """
    metric string as=weightMetricName !
    weight decimal as=weightValue !
""")
EFFECTIVE = class_map("WeightComponent", """
    metric string as=weightMetricName !
    effective_weight decimal as=weightValue !
    component_value decimal !
""")
RANKING = class_map("AttractivenessSnapshot", """
    backtest_run_id integer !
    run_label string !
    window_id string !
    ticker string as=rankingTicker !
    asset iri as=attractivenessOfAsset
    cycle iri as=rankingOfCycle !
    scheme iri as=computedWithScheme !
    score decimal as=attractivenessScore !
    finished_at dateTime as=computedAt !
    rank integer as=rankPosition !
    selected boolean as=selectedForBook !
    vetoed boolean as=vetoedAtRanking !
    veto_rules_json string
    target_weight decimal
    component iri as=hasEffectiveWeight many
""")
VETO = class_map("Veto", """
    ticker string as=vetoTicker !
    asset iri as=vetoOfAsset
    rule_iri iri as=appliesRule !
    rule_iri iri as=primaryRule !
    severity string as=vetoSeverity !
    raised_on date !
    cleared_on date
    last_seen_on date
    expires_on date
    run_text string as=runId !
    run_label string !
    window_id string !
    backtest_run_id integer !
    run_as_of date
""")
SCORE = class_map("ScoreSnapshot", """
    score_type string as=agentOrigin !
    metric_type string !
    computed_at dateTime as=timestamp !
    event_time date !
    available_at date !
    raw_value decimal
    risk decimal as=normalizedScore
    asset iri as=scoreSnapshotOfAsset inverse=hasScoreObservation !
""")
TICKER_HISTORY = class_map("TickerHistory", """
    cik string as=tickerHistoryCik !
    symbol string as=historicalSymbol !
    canonical_symbol string !
    valid_from date !
    valid_to date
    evidence_url anyURI
    evidence_day date as=evidenceDate
    rules string as=tickerHistoryRules
    asset iri as=tickerHistoryAsset
""")
ORCHESTRATOR_RUN = class_map("OrchestratorRun", """
    run_id integer as=orchestratorRunId !
    handle string
    kind string as=runKind
    code_version string
    status string
    settings_json string
    surface string
    as_of date as=runAsOf
    started_at dateTime
    finished_at dateTime
""")
ORCHESTRATOR_STEP = class_map("OrchestratorStep", """
    run iri as=stepOfOrchestratorRun !
    ordinal integer !
    handle string
    step string as=stepName
    status string
    run_kind string
    reason string
    argv_json string
    output_tail string
    started_at dateTime
    finished_at dateTime
    exit_code integer
    run_text string as=runId
""")
ASSET = class_map("Asset", """
    asset_symbol string as=tickerSymbol !
    company_name string
    cik string as=cikNumber
    industry iri as=classifiedAs
""")
MEMBERSHIP = class_map("UniverseMembership", """
    asset iri as=membershipAsset inverse=hasUniverseMembership !
    universe iri as=membershipUniverse !
    valid_from date !
    valid_to date
""")
NEWS_ITEM = class_map("NewsItem", """
    model_revision string !
    item_kind string !
    item_id string !
    ticker string as=newsTicker !
    asset_id integer as=newsAssetId
    date date as=newsDate !
    date_source string !
    title string as=newsTitle !
    text string as=newsText !
    text_source string !
    sentiment string as=newsSentiment !
    sentiment_score decimal !
    p_positive decimal !
    p_negative decimal !
    p_neutral decimal !
    sentiment_revision string !
    category string as=newsCategory !
    category_score decimal !
    group_label string !
    category_revision string !
    article_id integer
    source_domain string
    body_hash string !
    url anyURI
    asset iri as=newsItemOfAsset
""")
NEWS_ARTICLE = class_map("NewsArticle", """
    source_id string as=sourceDocument !
    ticker string as=newsTicker !
    published date as=eventTime !
    asset iri as=articleOfAsset
""")
SENTIMENT = class_map("ScoreSnapshot", """
    score_type string as=agentOrigin !
    metric_type string !
    raw_value decimal !
    published date as=eventTime !
    available_at date !
    asset iri as=scoreSnapshotOfAsset inverse=hasScoreObservation
""")
RISK_EVENT = class_map("RiskEvent", """
    category string as=eventCategory !
    severity string as=eventSeverity !
    published date as=eventTime !
    available_at date !
    article iri as=eventSource !
    asset iri as=eventOfAsset
""")
FILING = class_map("SECFiling", """
    asset iri as=filingOfAsset !
    form string as=formType !
    filing_date date !
    period_end date !
    fiscal_year integer !
    fiscal_period string !
    available_at date !
    accession_number string !
    filing_id integer !
""")
# Delivered metric names; each becomes a property of its metric set in camel case.
METRICS = (
    "asset_turnover", "capex_intensity", "cash_ratio", "current_ratio", "debt_to_assets", "debt_to_equity", "ebitda", "effective_tax_rate",
    "enterprise_fcf_yield", "enterprise_value", "free_cash_flow_conversion", "free_cash_flow_growth", "free_cash_flow_margin", "free_cash_flow_yield",
    "gross_margin", "interest_coverage", "inventory_turnover", "market_capitalization", "net_debt_to_ebitda", "net_income_cagr", "net_income_growth",
    "net_margin", "nopat", "operating_cash_flow_cagr", "operating_cash_flow_margin", "operating_income_growth", "operating_margin", "quick_ratio",
    "receivables_turnover", "return_on_assets", "return_on_equity", "return_on_invested_capital", "return_on_invested_capital_effective_rate",
    "revenue_cagr", "revenue_growth", "sbc_adjusted_fcf_yield", "utility_cash_coverage_3y",
)
METRIC_SET = class_map("FundamentalMetricSet", """
    filing iri as=metricSetOfFiling !
    available_at date !
    computed_at dateTime !
    engine_version string !
""" + "\n".join(f"    {m} decimal" for m in METRICS))
ASSESSMENT = class_map("FundamentalAssessment", """
    filing iri as=assessmentOfFiling !
    asset iri as=assessmentOfAsset !
    snapshot_id integer !
    score_raw_0_100 decimal as=scoreRaw0to100
    rating string
    narrative string !
    strengths string as=strength many
    risks string as=risk many
    model string !
    computed_at dateTime !
    event_time date !
    available_at date !
    generated_by_language_model boolean !
    provenance_note string !
""")
DAILY_SERIES = class_map("DailySeriesPoint", """
    configuration iri as=seriesOfConfiguration !
    window string as=windowId !
    date date as=seriesDate !
    gross_return decimal as=seriesGrossReturn
    net_return decimal as=seriesNetReturn
    turnover decimal as=seriesTurnover
    cost decimal as=seriesCost
    cash_weight decimal as=seriesCashWeight
    daily_total_return decimal
    value decimal as=seriesValue
""")
SERIES_WEIGHT = class_map("SeriesWeightPoint", """
    configuration iri as=seriesOfConfiguration !
    window string as=windowId !
    decision_date date as=seriesDate !
    asset_id integer as=seriesAssetId !
    weight decimal as=seriesWeight !
""")
TREND_STATE = class_map("TrendFilterState", """
    run_label string !
    window string as=trendWindow !
    decision_date date as=trendDecisionDate !
    state string as=trendState !
    news_risk_off boolean !
    cash_fraction decimal !
    arms string as=appliesToArm many
    set iri as=aggregatesSet !
""")
REFERENCE_RETURN = class_map("ReferenceReturn", """
    run_label string !
    window string as=returnWindow !
    segment string as=returnSegment !
    date_from date as=referenceDateFrom !
    date_to date as=referenceDateTo !
    n_sessions integer !
    reference string as=referenceName !
    total_return decimal as=referenceTotalReturn !
    max_drawdown decimal as=referenceMaxDrawdown !
    set iri as=aggregatesSet !
""")
AGGREGATES_SET = class_map("AggregatesSet", """
    run_label string !
    source_file string as=aggregatesSourceFile !
    source_sha256 string as=aggregatesSourceSha256 !
    config_id string as=aggregatesConfigId !
""")
RUN_CONFIGURATION = class_map("RunConfiguration", """
    run_label string !
    code_commit string as=configCodeCommit !
    pr string as=configPr !
    results_doc string as=configResultsDoc !
    config_id string
    status string as=configStatus
    body string as=comment !
""")
BACKTEST_RUN = class_map("BacktestRun", """
    run_label string !
    window_id string !
    configuration iri
    backtest_run_id integer !
    source_file string !
    source_sha256 string !
    knowledge_date date !
    run_configuration iri !
""")
DECISION = class_map("DecisionEvent", """
    book iri as=decisionOfBook !
    date date as=decisionDate !
    filter boolean as=filterState !
    filter_decision date as=filterDecisionDate !
    core_weight_in_force decimal !
    scale decimal as=exposureScale !
    candidate_pool_size integer !
    candidate_set_size integer !
    blocked_count integer !
    retained_count integer as=retainedCountOnDecision !
    cycle iri as=selectionCycle !
    rebalance iri as=bookRebalance !
    refilled iri as=refilledCandidate many
    date date as=knowledgeDate !
""")
FORMATION = class_map("FormationTarget", """
    decision iri as=targetOfDecision !
    asset iri as=targetAsset
    weight decimal as=formationTargetWeight !
""")
RETENTION = class_map("RetentionDecision", """
    book iri as=retentionOfBook !
    decision iri as=retentionOfDecision
    date date as=retentionDate !
    pool_size integer !
    held_outside_pool_count integer !
    retained_count integer !
    rejected_count integer !
    counter_dropped_count integer !
    kept_count integer !
    kept_weight decimal !
    candidate_set_size integer !
    max_decisions integer !
    enabled boolean as=retentionEnabled !
    dropped iri as=counterDroppedAsset many
    date date as=knowledgeDate !
""")
HOLD = class_map("RetentionHold", """
    decision iri as=holdOfDecision !
    asset iri as=retainedAsset
    counter integer as=retentionCounter !
    snapshot iri as=rankingSnapshot !
""")
REJECTION = class_map("RetentionRejection", """
    decision iri as=rejectionOfDecision !
    asset iri as=rejectedAsset
    cause string as=rejectionCause !
    counter integer as=retentionCounter !
    snapshot iri as=rankingSnapshot !
""")
STOP = class_map("StopEvent", """
    book iri as=stopOfBook !
    date date as=stopDate !
    asset iri as=stoppedAsset
    weight_before decimal as=stopWeightBefore !
    filter boolean as=filterState !
    filter_decision date as=filterDecisionDate !
    scale decimal as=exposureScale !
    rho_w0 decimal !
    rho decimal !
    chooser string !
    cash_left decimal !
    check_passed boolean as=portfolioCheckPassed !
    cause string as=stopCashCause
    eligible integer as=eligibleCount
    zone_evaluated integer
    zone_pass integer
    a_star decimal
    size_fraction decimal
    weight_after_e3 decimal
    rho_delta_min decimal
    rho_delta_median decimal
    rho_delta_max decimal
    chosen_cash boolean
    chosen_option iri
    date date as=knowledgeDate !
""")
OPTION = class_map("DestinationOption", """
    stop iri as=optionOfStop !
    asset iri as=optionAsset
    is_spy boolean as=optionIsSpy !
    rho decimal as=optionRho !
    r decimal as=optionR !
    beta decimal as=optionBeta !
    rank integer as=optionRank !
    score decimal as=optionScore !
    sector integer as=optionSector !
    size_fraction decimal as=optionSizeFraction !
    weight decimal as=optionWeight !
    position integer as=menuPosition !
""")
# Rejection causes of a stop; each is a property ``rejected<Cause>``.
STOP_CAUSES = (
    "hard_veto", "soft_penalty", "news_veto", "held", "memory", "not_ranked", "no_risk_model", "no_bar", "missing_return", "trend_break",
    "sector_cap", "spy_limit", "zone_high", "zone_no_signal", "NO_ALLOWED_DESTINATION",
)
STOP_SUMMARY = class_map("StopRejectionSummary", "    stop iri as=summaryOfStop !\n" + "\n".join(
    f"    rejected_{c.lower()} integer" for c in STOP_CAUSES))
PURCHASE = class_map("ReplacementPurchase", """
    stop iri as=purchaseOfStop !
    asset iri as=replacementAsset
    order_date date !
    execution_date date as=replacementExecutionDate !
    machine_entry_session date !
    weight decimal as=replacementWeight !
    size_fraction decimal !
    rank integer as=replacementRank !
    bucket string as=rankBucket !
    filter boolean as=filterState !
    filter_decision date as=filterDecisionDate !
    stopped_by iri as=replacementStoppedBy
""")
CHECK = class_map("ReplacementCheck", """
    purchase iri as=checkOfPurchase !
    date date as=checkDate !
    candidate boolean !
    kept boolean !
""")
MEMORY = class_map("StopMemory", """
    book iri as=memoryOfBook !
    asset iri as=memoryAsset
    since date as=memorySince !
    start_kind string as=memoryStartKind !
    released date as=memoryReleasedOn
    cause string as=memoryReleaseCause
""")
# Fields of the agent records; property names follow the rule.
MANAGER_CALL = class_map("ManagerCall", """
    date date as=knowledgeDate !
    window_id string !
    call_index integer !
    agent_arm string !
    stop iri as=callOfStop !
    stopped_asset_id integer as=callStoppedAssetId !
    answer_asset iri
    answer_label string
    answer_size_fraction decimal
    answer_is_cash boolean
    answer_is_spy boolean
    chosen_asset iri
    chosen_size_fraction decimal
    fallback_used_rule boolean !
    fallback_used_cash boolean !
    fallback_cause string
    fallback_detail string
    repair_used boolean !
    repair_cause string
    repair_detail string
    model_requested string !
    model_resolved string !
    provider_model_revision string
    reasoning_effort string
    prompt_sha256 string
    tool_order string many
    turn_count integer
    attempt_count integer
    usage_input_tokens integer
    usage_output_tokens integer
    usage_total_tokens integer
    validator_passed boolean
    validator_cause string
    validator_detail string
    generated_by_language_model boolean !
    source_document string !
    source_line_number integer !
    record_source_sha256 string !
""")
NARRATOR_TEXT = class_map("NarratorText", """
    date date as=knowledgeDate !
    window_id string !
    kind string as=narratorKind !
    text string as=narratorText !
    source string as=narratorSource !
    source_kind string !
    source_date date !
    source_asset_id integer
    source_line integer as=sourceEventLine
    line integer as=sourceLineNumber !
    stop iri as=narratorOfStop
    model_requested string
    model_resolved string
    prompt_sha256 string
    validator_passed boolean
    generated_by_language_model boolean !
    omitted string as=omittedField many
    source_document string !
    record_source_sha256 string !
""")
NEWS_RUN = class_map("NewsRunRecord", """
    date date as=knowledgeDate !
    window_id string !
    configuration iri as=agentRecordOfConfiguration !
    news_mode string !
    news_alpha decimal !
    news_exits integer
    news_sector_rejections integer
    news_date_count integer !
    run_id string !
""")
DATE_RECORD = class_map("DateRecord", """
    date date as=dateRecordDate !
    window_id string !
    run iri as=dateRecordOfRun !
    coverage_first date
    coverage_last date
    has_temporal_coverage boolean !
    admitted_count integer
    pool_size integer !
    complete_pool boolean !
    dropped string as=droppedCondition many
    level_c boolean as=levelCDecision
    level_c_flagged_count integer
    level_d boolean as=levelDFired
    date date as=knowledgeDate !
""")
NEWS_ACTION = class_map("NewsAction", """
    date date as=knowledgeDate !
    window_id string !
    kind string as=newsActionKind !
    asset iri as=newsActionAsset !
    ticker string as=newsActionTicker !
    date_record iri as=newsActionOfDateRecord !
    run iri as=newsActionOfRun !
    evidence iri as=newsActionEvidence inverse=newsEvidenceOfAction !
    replaces iri as=newsReplacesAsset
    replaced_by iri as=newsReplacedByAsset
    filled boolean as=newsActionFilled !
    fill_asset iri as=newsActionFillAsset
    test_rows string as=newsTestRow many
""")
NEWS_EVIDENCE = class_map("NewsEvidence", """
    window_id string !
    asset iri as=newsEvidenceAsset !
    ticker string as=newsEvidenceTicker !
    state string as=newsEvidenceState !
    n integer as=newsN !
    a integer as=newsA !
    b integer as=newsB !
    covered boolean as=newsCovered !
    conflict boolean as=newsConflict
    items iri as=newsItem many
""")
BULL_RECORD = class_map("BullModeRecord", """
    date date as=knowledgeDate !
    window_id string !
    configuration iri as=agentRecordOfConfiguration !
    bull_mode string as=bullModeName !
    bull_beta_target decimal !
    bull_z_star decimal !
    date date as=bullFormationDate !
    bull_triggered_count integer !
    decisions iri as=bullDecision many
""")
BULL_DECISION = class_map("BullModeDecision", """
    date date as=bullDecisionDate !
    window_id string !
    record iri as=bullDecisionOfRecord !
    evaluable boolean as=bullEvaluable !
    triggered boolean as=bullTriggered !
    z decimal as=bullZ
    rung integer as=bullRung
    t1 string as=bullT1
    n integer as=bullSignalCount
    date date as=knowledgeDate !
""")

ALL: dict[str, ClassMap] = {k: v for k, v in list(globals().items()) if isinstance(v, ClassMap)}
