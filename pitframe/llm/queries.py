"""One registered query for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitframe.llm import ann, collocations, decontaminate, importance, line_dedup, mixing, quality, simhash, suffix_dedup, token_count, token_store, toxicity, url_filter
from pitframe.llm.common import ship
from pitframe.llm.common import table as read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return read_table(spark, sf_dir, name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return x.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return x.select(F.col("item").alias("item_id"), F.col("id").alias("doc_id"), "n_shingles", "n_shared")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return x.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = mixing.mix(table(spark, sf_dir, "documents"))
    return x.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", "times")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_digest(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = token_count.token_counts(table(spark, sf_dir, "documents"))
    return x.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "embeddings")
    return ann.nearest(x, x.filter("vec_id % 20 = 0"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read_table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark)).withColumnRenamed("id", "page_id")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return x.withColumnRenamed("id", "doc_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_decontamination, op3_simhash, op4_mixing, op5_nearest, op6_token_store, op7_quality, op8_token_counts, op9_toxicity, op10_line_dedup, op11_url_filters, op12_importance, op13_collocations)}
_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '')"
SQL: dict[str, str] = {
    "op2_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, w, least(5, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
          s AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
          t AS (SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM d JOIN (SELECT DISTINCT k FROM i) ON k <= len(w))),
          n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY 1)
        SELECT item_id, doc_id, n_shingles, count(*) AS n_shared FROM s JOIN t USING (k, g) JOIN n USING (item_id) GROUP BY 1, 2, 3 HAVING count(*) >= 0.8 * n_shingles""",
    # crc32 a byte at a time over each distinct word; its table of 256 is eight halvings of each index
    "op12_importance": """
        WITH c AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS t),
          words AS (SELECT src, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
                    FROM (SELECT 's' AS src, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark)),
          hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
          buckets AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                        lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, c),
          counts AS (SELECT bucket, count(*) FILTER (src = 's') AS s, count(*) FILTER (src = 't') AS t FROM words JOIN buckets USING (w) GROUP BY 1),
          gains AS (SELECT bucket, CAST(floor(1000.0::DOUBLE * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts),
          sums AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE src = 's' GROUP BY 1),
          x AS (SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                  CAST(coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296.0::DOUBLE))) AS BIGINT) AS score
                FROM documents LEFT JOIN sums USING (doc_id)),
          r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS all_n FROM x WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * all_n // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (doc_id)""",
    "op13_collocations": """
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
          w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
          f AS (SELECT lang, size, phrase, count(*) AS f FROM (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda p: array_to_string(w[p:p + size - 1], ' '))) AS phrase
                FROM w, range(1, 6) AS sizes(size)) GROUP BY ALL),
          n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY 1),
          cand AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS p, f AS a FROM f WHERE size > 1 AND f >= 100),
          cuts AS (SELECT *, array_to_string(p[1:k], ' ') AS head, array_to_string(p[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
          scored AS (SELECT c.lang, c.phrase, c.a, k, h.f AS l, r.f AS r, n, CAST(1000::HUGEINT * a * n // (h.f::HUGEINT * r.f) AS BIGINT) AS score
                     FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head AND h.size = k JOIN f r ON r.lang = c.lang AND r.phrase = c.rest AND r.size = c.size - k JOIN n ON n.lang = c.lang),
          low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
          inner_ AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda s: list_transform(range(1, size - s + 2), lambda i: array_to_string(p[i:i + s - 1], ' '))))) AS phrase
                     FROM cand WHERE size > 2) GROUP BY ALL),
          kept AS (SELECT low.* FROM low LEFT JOIN inner_ i ON i.lang = low.lang AND i.phrase = low.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * low.a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000""",
}


def all_queries() -> dict:
    """With the pipeline, which lives beside the package's folder."""
    import corpus_pipeline
    return QUERIES | {"pipeline": corpus_pipeline.run}
