"""Scalar Columns: scores, severity, text, dates. All stay in whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lanes whose 0-100 strength is rescaled.
STRENGTH_LANES = ("VALORIZATION", "TECHNICAL", "SECTOR")
# Classifier label -> event category; any other label has none.
CATEGORY_BUCKET = {
    "legal_regulatory": "LEGAL",
    "earnings_performance": "FINANCIAL",
    "capital_shareholder_returns": "FINANCIAL",
    "mergers_acquisitions": "FINANCIAL",
    "market_analyst_sentiment": "MARKET",
    "product_innovation": "MARKET",
    "partnerships_business_dev": "MARKET",
    "leadership_governance": "NETWORK",
    "labor_human_capital": "NETWORK",
}
# Words that raise the severity by one step, the ladder, and its bounds.
HARD_KEYWORDS = (
    "lawsuit", "sec investigation", "investigation", "restatement", "material weakness", "class action",
    "subpoena", "indictment", "fraud", "settlement", "recall",
)
LADDER = ("LOW", "MODERATE", "HIGH", "CRITICAL")
GATE_NEGATIVE, GATE_SCORE = 0.50, 0.70
CRITICAL_NEGATIVE, CRITICAL_SCORE, HIGH_NEGATIVE, MODERATE_NEGATIVE = 0.85, 0.80, 0.70, 0.50
TICKER = r"^[A-Z0-9]{1,6}(\.[A-Z])?$"


def clamp(col: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


def net_polarity(positive: Column, negative: Column) -> Column:
    """``positive - negative`` in [-1, 1]."""
    return clamp(positive - negative, -1.0, 1.0)


def strength_to_risk(score: Column) -> Column:
    """0-100 strength to 0-1 risk, exact: ``(100 - x) / 100``; NULL for NULL."""
    d = score.cast("decimal(20,10)")
    return ((F.lit(100).cast("decimal(20,10)") - d) / F.lit(100)).cast("decimal(22,12)")


def strength_violation(lane: Column, score: Column) -> Column:
    """Why a strength cannot be rescaled: unknown lane or outside 0-100; NULL if it can."""
    return F.when(~lane.isin(*STRENGTH_LANES), "unknown lane").when((score < 0) | (score > 100), "outside range")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def compounded(r: Column) -> Column:
    """Aggregate ``(1+r1)(1+r2)... - 1``."""
    return F.product(F.lit(1) + r) - 1


def category_bucket(label: Column) -> Column:
    pairs = [x for k, v in CATEGORY_BUCKET.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), label)


def creation_gate(negative: Column, score: Column) -> Column:
    return (negative >= GATE_NEGATIVE) | (score >= GATE_SCORE)


def has_hard_keyword(body: Column) -> Column:
    low = F.lower(F.coalesce(body, F.lit("")))
    return reduce(lambda a, b: a | b, [low.contains(k) for k in HARD_KEYWORDS])


def severity(negative: Column, score: Column, category: Column, body: Column) -> Column:
    """LOW..CRITICAL, one step higher if the body holds a hard keyword."""
    step = (
        F.when((negative >= CRITICAL_NEGATIVE) & (score >= CRITICAL_SCORE) & category.isin("LEGAL", "FINANCIAL"), 3)
        .when(negative >= HIGH_NEGATIVE, 2).when(negative >= MODERATE_NEGATIVE, 1).otherwise(0))
    step = F.least(step + has_hard_keyword(body).cast("int"), F.lit(3))
    return F.element_at(F.array(*[F.lit(x) for x in LADDER]), step + 1)


def clean_symbol(col: Column) -> Column:
    """Trim, drop trailing bars, trim again."""
    return F.trim(F.regexp_replace(F.trim(col), r"\|+$", ""))


def is_ticker(col: Column) -> Column:
    return col.rlike(TICKER)


def safe_part(col: Column) -> Column:
    return col.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")


def legal_iri(col: Column) -> Column:
    return col.rlike(r"^[^\x00-\x20<>\"{}|^`\\]+$")


def local_name(col: Column) -> Column:
    """Part of an IRI after the last ``#``, else after the last ``/``."""
    return F.when(col.contains("#"), F.substring_index(col, "#", -1)).otherwise(F.substring_index(col, "/", -1))


def turtle_escape(col: Column) -> Column:
    out = col
    for raw, esc in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def strict_day(col: Column) -> Column:
    """The calendar date of a ``YYYY-MM-DD`` text, else NULL."""
    return F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}$"), col.try_cast("date"))


def utc_timestamp(col: Column) -> Column:
    """The instant of an ISO text ending in ``+00:00`` or ``Z``, else NULL."""
    return F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(\+00:00|Z)$"), col.try_cast("timestamp"))


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def day_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def published_date(published: Column, fetched: Column) -> Column:
    """Publication day, else the fetch day; NULL if neither reads as a date."""
    return F.coalesce(strict_day(F.substring(published, 1, 10)), strict_day(F.substring(fetched, 1, 10)))


def available_at(published: Column, *processed: Column) -> Column:
    """The later of publication and every processing day."""
    return F.greatest(published, *processed)


def suppress(col: Column, when: Column) -> Column:
    """The value unless the condition holds."""
    return F.when(~F.coalesce(when, F.lit(False)), col)


def destination(cash: Column, is_spy: Column, ticker: Column) -> Column:
    """Where a stop went: cash, SPY, a ticker, or no destination; missing flags are false."""
    no = F.lit(False)
    return F.when(F.coalesce(cash, no), "cash").when(F.coalesce(is_spy, no), "SPY").otherwise(F.coalesce(ticker, F.lit("no destination")))


def weak_reasons(roic: Column, debt: Column, score: Column, min_roic, max_debt, min_score) -> Column:
    """Joined reasons of a weak holding, empty if none; a missing score counts as 100."""
    return F.concat(F.when(roic < min_roic, "low ROIC; ").otherwise(""), F.when(debt > max_debt, "high debt; ").otherwise(""),
                    F.when(F.coalesce(score, F.lit(100)) < min_score, "low assessment").otherwise(""))


def is_sha256(col: Column) -> Column:
    return col.rlike(r"^[0-9a-f]{64}$")


def provenance(table: str, ident: Column) -> Column:
    return F.concat(F.lit(f"{table}:"), ident.cast("string"))


def lang_matches(lang: Column, wanted: str) -> Column:
    """Basic language range match: ``es`` matches ``es`` and ``es-MX``."""
    low = F.lower(F.coalesce(lang, F.lit("")))
    return (low == wanted.lower()) | low.startswith(f"{wanted.lower()}-")


def text_list_ok(col: Column) -> Column:
    """An array of non-empty texts."""
    return F.forall(col, lambda x: x.isNotNull() & (F.length(F.trim(x)) > 0))


def number_map_ok(col: Column) -> Column:
    """A map whose values are all finite numbers."""
    return F.forall(F.map_values(col), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def json_keys_are(col: Column, keys) -> Column:
    """Whether a JSON object has exactly these keys."""
    want = F.array(*[F.lit(k) for k in sorted(keys)])
    return F.coalesce(F.array_sort(F.json_object_keys(col)) == want, F.lit(False))


def forbidden_json_keys(col: Column, keys, nested=()) -> Column:
    """Refused keys of a JSON object and of the named nested objects (dotted paths)."""
    bad = F.array(*[F.lit(k) for k in keys])
    found = F.coalesce(F.array_intersect(F.json_object_keys(col), bad), F.array().cast("array<string>"))
    for path in nested:
        inner = F.json_object_keys(F.get_json_object(col, f"$.{path}"))
        found = F.concat(found, F.coalesce(F.array_intersect(inner, bad), F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(found))
