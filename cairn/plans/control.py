"""Steering rules, sinks' shapes and direct answers over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import answers
from cairn.operators import control
from cairn.sources import sinks
from cairn.streaming import timers

from . import sdc
from .catalogue import ORACLES, folder, query, table
from .streams import _drained


@query("""
    SELECT doc_id, CASE WHEN quality = 1 THEN 'https://full.example/' ELSE 'https://thumb.example/' END || doc_id AS url, sha256(CASE WHEN quality = 1 THEN text ELSE source END) AS sha256
    FROM documents JOIN labels USING (doc_id) WHERE quality = 1 OR toxic = 0""")
def tier_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best address of each document that was fetched: the full one where the label says good, the small one where it isn't toxic."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    at = lambda size: F.concat(F.lit(f"https://{size}.example/"), F.col("doc_id"))
    fetched = docs.join(labels, "doc_id").select(F.explode(F.array(
        F.struct(at("full").alias("url"), F.sha2("text", 256).alias("sha256"), (F.col("quality") == 1).alias("ok")),
        F.struct(at("thumb").alias("url"), F.sha2("source", 256).alias("sha256"), (F.col("toxic") == 0).alias("ok")),
    )).alias("f")).select("f.*")
    return control.first_good_tier(docs.select("doc_id", F.array(F.lit("data:none"), at("full"), at("thumb")).alias("tiers")), fetched, "doc_id")


@query("""
    SELECT doc_id, CASE WHEN quality = 1 AND trim(text) <> '' THEN 'full' WHEN toxic = 0 AND trim(lang) <> '' THEN 'archive' ELSE 'snippet' END AS label
    FROM documents LEFT JOIN labels USING (doc_id)""")
def body_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    chain = [("full", F.when(F.col("quality") == 1, F.col("text"))), ("archive", F.when(F.col("toxic") == 0, F.col("lang"))), ("snippet", F.lit("none"))]
    return docs.select("doc_id", control.fallback_body(chain)["label"].alias("label"))


_BRANDS = "SELECT DISTINCT p_brand AS name FROM part"


@query(f"""
    SELECT name, name AS query, 'zh' AS lang, right(name, 1) = '2' AS judge FROM ({_BRANDS})
    UNION ALL SELECT name, lower(name), 'latin', false FROM ({_BRANDS}) WHERE right(name, 1) NOT IN ('1', '2')""")
def instance_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as concepts; those that end in 1 were judged and rejected, those in 2 not judged."""
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    last = F.right("name", F.lit(1))
    cache = brands.where(last != "2").withColumn("alias", F.when(last != "1", F.lower("name")))
    return control.instance_seeds(brands, cache)


@query("""
    WITH c AS (SELECT source AS name, count(*) FILTER (WHERE toxic = 1) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
    SELECT name, concat_ws(' ', name, w) AS query, 'zh' AS lang, 2 AS top_n_hint FROM c, (VALUES ('百科'), ('介绍')) v(w) WHERE n < 2""")
def second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Further searches for sources with fewer than two toxic documents."""
    joined = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return control.second_pass(joined.groupBy(F.col("source").alias("name")).agg(F.count_if(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("n")))


@query("""
    WITH p AS (SELECT p_name AS name, arg_min(p_brand, p_partkey) AS branch, min(p_partkey) AS pos FROM part GROUP BY 1)
    SELECT branch, list(name ORDER BY pos, name) AS samples FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY branch ORDER BY pos, name) <= 12) GROUP BY 1""")
def branch_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twelve names of each brand (a planner's samples); a name counts for its first brand."""
    return control.branch_samples(table(spark, sf_dir, "part").withColumnRenamed("p_brand", "branch"), "p_name", "branch", "p_partkey")


@query("""
    WITH c AS (SELECT event_type AS engine, epoch(ts)::DOUBLE AS called, value >= 1 AS ok FROM events), r AS (SELECT engine, max(called) FILTER (WHERE ok) AS resumed FROM c GROUP BY 1)
    SELECT engine, count(*) FILTER (WHERE NOT ok AND (resumed IS NULL OR called > resumed)) AS errors, round(max(called) FILTER (WHERE NOT ok AND (resumed IS NULL OR called > resumed)) + 5, 3) AS until
    FROM c JOIN r USING (engine) GROUP BY 1""")
def engine_suspension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event type stands if events of a value under 1 are failures."""
    calls = table(spark, sf_dir, "events").withColumn("ok", F.col("value") >= 1)
    return control.suspensions(calls, "event_type", "ts", "ok").withColumn("until", F.round("until", 3))


#: What the timers of an hour's slots, two days behind the events, have settled by the end.
_SETTLED = "(SELECT to_timestamp(floor(epoch(max(ts) - INTERVAL 2 DAY) / 3600) * 3600)::TIMESTAMP FROM events)"


@query(f"""
    WITH c AS (SELECT CASE WHEN event_id % 10 < 9 THEN 'hot' ELSE event_type END AS engine, event_id, ts, value >= 10 AS ok FROM events),
    g AS (SELECT *, sum(ok::INT) OVER w AS run, lead(ts) OVER w AS next FROM c WINDOW w AS (PARTITION BY engine ORDER BY date_trunc('millisecond', ts), ok)),
    e AS (SELECT *, count(*) FILTER (WHERE NOT ok) OVER (PARTITION BY engine, run ORDER BY date_trunc('millisecond', ts), ok ROWS UNBOUNDED PRECEDING) AS errors FROM g),
    s AS (SELECT * FROM e WHERE NOT ok AND ts < {_SETTLED})
    SELECT engine, max(errors)::BIGINT AS longest, sum(errors)::BIGINT AS total,
        count(*) FILTER (WHERE date_trunc('millisecond', ts) + INTERVAL 5 MINUTE < {_SETTLED} AND (next IS NULL OR date_trunc('millisecond', next) > date_trunc('millisecond', ts) + INTERVAL 5 MINUTE)) AS lapsed FROM s GROUP BY engine""")
def stream_suspension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of failures of each event type and the bans of five minutes that lapsed, followed over three batches out of order; nine of ten events are of one engine.

    A batch has ten days of the events, but those of its last day with an even number come with the next.
    """
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_id") % 10 < 9, "hot").otherwise(F.col("event_type")).alias("engine"), (F.col("value") >= 10).alias("ok"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    day = F.floor(F.date_diff("ts", F.lit(first).cast("date")))
    late = (day % 10 == 9) & (F.col("event_id") % 2 == 0)
    batch = F.least(F.lit(2), F.floor(day / 10) + F.when(late, 1).otherwise(0))
    path = folder(spark, "calls")
    for k in range(3):
        events.where(batch == k).coalesce(1).write.mode("append").parquet(path)  # a file a batch
    calls = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path).withWatermark("ts", "2 days")
    log = timers.suspension_log(calls, "engine", "ts", "ok", 300.0, slot=3600.0)
    settled = F.timestamp_seconds(F.floor((F.unix_seconds(F.lit(last)) - 2 * 86_400) / 3600) * 3600)
    done = _drained(log, "suspensions").where(F.col("at") < settled)
    failed = F.col("event") == "fail"
    return done.groupBy("engine").agg(F.max(F.when(failed, F.col("errors"))).alias("longest"), F.sum(F.when(failed, F.col("errors"))).alias("total"), F.count_if(F.col("event") == "over").alias("lapsed"))


@query("""
    SELECT user_id AS key, arg_max(event_id, (ts, event_id)) AS value FROM events, (SELECT max(ts) AS now FROM events)
    WHERE event_type = 'click' AND ts + INTERVAL 1 DAY > now GROUP BY 1""")
def ttl_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cache of clicks still holds a day after they came."""
    events = table(spark, sf_dir, "events")
    cache = events.select(F.col("event_type").alias("context"), F.col("user_id").alias("key"), F.col("event_id").alias("value"), F.col("ts").alias("stored_at"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("expire_at"))
    now = F.lit(events.agg(F.max("ts")).first()[0])
    return control.live(cache, "click", now)


if "sdc_manifest" in ORACLES:

    @query(f"SELECT fname, mid, size, split_part(pair, ':', 1) AS qid, split_part(pair, ':', 2) AS rank FROM (SELECT fname, mid, size, unnest(string_split(pairs, ',')) AS pair FROM ({ORACLES['sdc_manifest']}))")
    def manifest_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The rows that the ledger of a fetch gets: one a file and concept."""
        return sinks.split_pairs(sdc.sdc_manifest(spark, sf_dir), "pairs")


@query("""
    SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, url, NULL AS content, NULL AS host, NULL AS engine, page_id::VARCHAR AS score, 'result' AS type, 0 AS type_rank FROM pages
    UNION ALL SELECT c_name, NULL, NULL, NULL, c_mktsegment, NULL, 'suggestion', 2 FROM customer""")
def export_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), "url", F.col("page_id").alias("score"))
    return sinks.export_rows(pages, suggestions=table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("engine")))


@query("""
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_acctbal + c_custkey WHEN 1 THEN (c_acctbal + c_custkey) / 2 WHEN 2 THEN greatest(c_acctbal, c_custkey) ELSE NULL END::DOUBLE AS value,
        CASE c_custkey % 3 WHEN 0 THEN md5(c_name) WHEN 1 THEN sha256(c_name) ELSE sha1(c_name) END AS digest FROM customer""")
def direct_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and digests that customers ask for; every fourth asks for no statistic."""
    pick = lambda words: F.get(F.array(*map(F.lit, words)), (F.col("c_custkey") % len(words)).cast("int"))
    statistic = F.concat_ws(" ", pick(("sum", "avg", "max", "who")), F.col("c_acctbal").cast("string"), F.col("c_custkey").cast("string"))
    digest = F.concat_ws(" ", pick(("md5", "sha256", "sha1")), "c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", answers.statistic(statistic).alias("value"), answers.digest(digest).alias("digest"))


#: Units for the queries: symbol, quantity, factor and shift to SI, place.
UNITS = [("km", "metre", 1000.0, 0.0, 0), ("mi", "metre", 1609.344, 0.0, 1), ("C", "kelvin", 1.0, 273.15, 2), ("F", "kelvin", 5 / 9, 459.67 * 5 / 9, 3), ("C", "coulomb", 1.0, 0.0, 4), ("Ah", "coulomb", 3600.0, 0.0, 5)]


@query("""
    SELECT p_partkey, round(CASE p_partkey % 3 WHEN 0 THEN p_size * 1000 / 1609.344 WHEN 1 THEN p_size * 1.8 + 32 ELSE p_size / 3600.0 END, 6)::DOUBLE AS value,
        CASE p_partkey % 3 WHEN 0 THEN 'mi' WHEN 1 THEN 'F' ELSE 'Ah' END AS symbol FROM part""")
def unit_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of parts asked for in other units; C is both a temperature and a charge."""
    units = spark.createDataFrame(UNITS, "symbol string, quantity string, factor double, shift double, position int")
    pair = F.get(F.array(*map(F.lit, ("km in mi", "C in F", "C to Ah"))), (F.col("p_partkey") % 3).cast("int"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", F.col("p_size").cast("string"), pair).alias("asked"))
    return answers.convert_units(parts, "p_partkey", "asked", units).withColumn("value", F.round("value", 6))


@query("SELECT CASE n_name WHEN 'X' THEN 0 ELSE -1 END::BIGINT AS n_nationkey, 'Asia/Tokyo' AS zone, TIMESTAMP '2024-07-01 21:00:00' AS local FROM nation WHERE n_nationkey = 0 UNION ALL SELECT -2, 'UTC', TIMESTAMP '2024-07-01 12:00:00' UNION ALL SELECT n_nationkey, CASE lower(n_name) WHEN 'france' THEN 'Europe/Paris' WHEN 'japan' THEN 'Asia/Tokyo' ELSE 'America/Lima' END, CASE lower(n_name) WHEN 'france' THEN TIMESTAMP '2024-07-01 14:00:00' WHEN 'japan' THEN TIMESTAMP '2024-07-01 21:00:00' ELSE TIMESTAMP '2024-07-01 07:00:00' END FROM nation WHERE lower(n_name) IN ('france', 'japan', 'peru')")
def local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The local time in the place that each nation asks about."""
    places = spark.createDataFrame([("france", "Europe/Paris"), ("japan", "Asia/Tokyo"), ("peru", "America/Lima")], "place string, zone string")
    asked = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("time "), F.col("n_name")).alias("asked"))
    asked = asked.union(spark.createDataFrame([(-1, "time japan"), (-2, "clock")], "k int, q string"))
    return answers.local_times(asked, "n_nationkey", "asked", F.lit("2024-07-01 12:00:00").cast("timestamp"), places)
