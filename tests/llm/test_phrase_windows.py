"""A task that counts windows hands on each of them once, however many words and parts it reads."""

from pyspark.sql import functions as F

from pitframe.llm import collocations


def test_a_window_comes_once_from_a_task(spark, monkeypatch):
    monkeypatch.setattr(collocations, "KNOWN", 400)
    text = F.concat(F.lit("new york city hall. the city. "), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("w"), F.col("id") * 10 + i)), " "))
    docs = spark.range(2000, numPartitions=16).select(F.lit("en").alias("lang"), text.alias("text"))
    rows = docs.select("lang", F.col("text").cast("binary").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        frequent = collocations.frequent_slots(rows, 100, 20, 5)
        frequent += collocations.frequent_slots(rows, 100, 20, 5, frequent)
        out = collocations.windows(rows, frequent, 5, 20)
        assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism == 4
        many = out.groupBy(F.spark_partition_id().alias("task"), *[c for c in out.columns if c != "n"]).agg(F.count("*").alias("rows"))
        assert many.agg(F.max("rows")).first()[0] == 1
        sums = {tuple(x for x in r[:5] if x): r["n"] for r in out.groupBy("w1", "w2", "w3", "w4", "w5").agg(F.sum("n").alias("n")).collect()}
        assert sums["new", "york", "city", "hall"] == sums["york", "city", "hall"] == sums["city", "hall"] == sums["hall",] == sums["the", "city"] == sums["city",] == 2000
        assert sum(sums.values()) == 2000 * 16
        counts = {r["phrase"]: r["f"] for r in collocations.phrase_counts(docs, bits=20).filter("size > 0").collect()}
        assert counts["city"] == 4000 and counts["new york city hall"] == 2000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
