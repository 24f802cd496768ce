"""Statistics in states of bounded size that merge: histograms of engines, shards of an audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import histograms
from cairn.functions.text import magic_class

from .catalogue import folder, query, table

#: Width and number of buckets: of times in tenths of a second, of scores in hundredths.
TIMES, SCORES = (0.1, 600), (0.01, 200)
_HISTOGRAM = """
    h AS (SELECT engine, greatest(0, least({size} - 1, trunc({value} / {width})::BIGINT)) AS bucket, count(*) AS n, sum({value}) AS total FROM c GROUP BY 1, 2),
    q AS (SELECT *, sum(n) OVER (PARTITION BY engine ORDER BY bucket) AS up, sum(n) OVER (PARTITION BY engine) AS whole FROM h)"""
_READ = "(min(bucket) FILTER (WHERE up * 100 >= whole * {0}) * {1})::DOUBLE AS p{0}"


@query(f"""
    WITH c AS (SELECT event_type AS engine, value / 4 - 1 AS took, 1.0::DOUBLE / (1 + user_id % 9) AS score FROM events), {_HISTOGRAM.format(value='took', width=TIMES[0], size=TIMES[1])},
    t AS (SELECT engine, sum(n)::BIGINT AS count, round(sum(total) / sum(n), 6) AS average, {', '.join(_READ.format(p, TIMES[0]) for p in (50, 80, 95))} FROM q GROUP BY engine),
    s AS (SELECT engine, round(sum(score) / count(*), 6) AS score_per_result FROM c GROUP BY engine)
    SELECT engine, count, average, p50, p80, p95, score_per_result FROM t JOIN s USING (engine)""")
def engine_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing times of each event type (count, mean, 50, 80 and 95 percent) and score a result, read from histograms that were stored for each day and merged."""
    calls = table(spark, sf_dir, "events").select(F.col("event_type").alias("engine"), F.to_date("ts").alias("day"), (F.col("value") / 4 - 1).alias("took"), (1.0 / (1 + F.col("user_id") % 9)).alias("score"))
    path = folder(spark, "histograms")
    for name, (width, size) in (("took", TIMES), ("score", SCORES)):
        histograms.histograms(calls, ["engine", "day"], name, width, size).write.parquet(f"{path}/{name}")
    took = histograms.quantiles(spark.read.parquet(f"{path}/took"), ["engine"], TIMES[0], {"p50": 50, "p80": 80, "p95": 95})
    score = histograms.quantiles(spark.read.parquet(f"{path}/score"), ["engine"], SCORES[0], {})
    return took.withColumn("average", F.round("average", 6)).join(score.select("engine", F.round("average", 6).alias("score_per_result")), "engine")


@query("""
    WITH h AS (SELECT source, greatest(0, least(19, n_chars // 500)) AS bucket, count(*) AS n FROM documents GROUP BY 1, 2)
    SELECT source, bucket * 500.0::DOUBLE AS at, (n * 100 // sum(n) OVER (PARTITION BY source))::INT AS percent FROM h QUALIFY percent > 0""")
def size_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percents of each source's documents by size, in steps of 500 characters, the last open."""
    docs = table(spark, sf_dir, "documents").select("source", "n_chars")
    return histograms.shares(histograms.histograms(docs, ["source"], "n_chars", 500, 20), ["source"], 500)


@query("""
    WITH s AS (SELECT CASE doc_id % 4 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'html' WHEN 2 THEN 'empty' ELSE 'png' END AS class, doc_id % 3 AS tier, CASE WHEN doc_id % 4 = 1 THEN CASE WHEN doc_id % 8 = 1 THEN '404' ELSE '429' END END AS err, n_chars, md5(text) AS sha FROM documents)
    SELECT class, count(*) AS n, sum(n_chars)::BIGINT AS bytes, count(*) FILTER (WHERE tier = 0) AS tier0, count(err) AS errors, count(*) FILTER (WHERE err = '429') AS limited, count(DISTINCT sha) AS shas, true AS near FROM s GROUP BY class""")
def merged_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit's counts by class, merged from the stored states of four shards without reading the rows again; distinct digests from merged sketches beside a recount."""
    d = F.col("doc_id")
    head = F.when(d % 4 == 0, F.unhex(F.lit("FFD8FF00"))).when(d % 4 == 1, F.concat(F.lit("<html>Error: "), F.when(d % 8 == 1, "404").otherwise("429")).cast("binary")).when(d % 4 == 2, F.unhex(F.lit(""))).otherwise(F.unhex(F.lit("89504E47")))
    told = magic_class(head)
    rows = table(spark, sf_dir, "documents").select(
        (d % 16 % 4).alias("shard"), F.substring_index(told, "(", 1).alias("class"), F.nullif(F.regexp_extract(told, "\\(([0-9]{3})\\)", 1), F.lit("")).alias("err"), (d % 3).alias("tier"), "n_chars", F.md5("text").alias("sha")
    )
    path = folder(spark, "shards")
    states = rows.groupBy("shard", "class").agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("bytes"), F.count_if(F.col("tier") == 0).alias("tier0"), F.count("err").alias("errors"), F.count_if(F.col("err") == "429").alias("limited"), F.hll_sketch_agg("sha", 12).alias("sketch")
    )
    states.write.partitionBy("shard").parquet(path)
    sums = [F.sum(c).alias(c) for c in ("n", "bytes", "tier0", "errors", "limited")]
    merged = spark.read.parquet(path).groupBy("class").agg(*sums, F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    exact = rows.groupBy("class").agg(F.countDistinct("sha").alias("shas"))
    near = F.abs(F.col("estimate") - F.col("shas")) <= F.greatest(F.lit(1.0), 3 * 1.04 / 64 * F.col("shas"))  # three standard errors of 2**12 registers
    return merged.join(exact, "class").select("class", "n", "bytes", "tier0", "errors", "limited", "shas", near.alias("near"))
