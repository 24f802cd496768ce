"""Reports: source health, fleet, profiles, timelines, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import alerts, control, gates
from cairn.operators.relational import decile, global_rank
from cairn.streaming.streams import memory_breach, stalls

from .catalogue import query, table


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "ts")
    now = events.agg(F.max("ts").alias("now"))  # one row
    since = F.col("now").cast("timestamp").cast("double") - F.col("ts").cast("timestamp").cast("double")
    return events.join(F.broadcast(now)).groupBy(F.col("event_type").alias("source")).agg(
        F.count("*").alias("rows"), F.count_if(since <= 86400).alias("w24"), F.count_if(since <= 3600).alias("w1")
    )


_W = """SELECT event_type AS source, count(*) AS rows, count(*) FILTER (WHERE now - ts <= INTERVAL 1 DAY) AS w24, count(*) FILTER (WHERE now - ts <= INTERVAL 1 HOUR) AS w1
    FROM events, (SELECT max(ts) AS now FROM events) GROUP BY event_type"""


@query(_W)
def source_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir)


@query(f"""
    WITH y AS ({_W}), n AS (SELECT max(ts)::TIMESTAMP AS now FROM events),
    e AS (SELECT event_type AS source FROM events UNION SELECT * FROM (VALUES ('idle_new'), ('idle_old'), ('idle_on_probation'))),
    l(source, dead_since, probation) AS (SELECT 'idle_old', now - INTERVAL 80 HOUR, NULL FROM n UNION ALL SELECT 'idle_on_probation', now - INTERVAL 200 HOUR, now - INTERVAL 100 HOUR FROM n
        UNION ALL SELECT 'click', now - INTERVAL 9 HOUR, NULL FROM n),
    j AS (SELECT source, coalesce(rows, 0)::BIGINT AS rows, coalesce(w24, 0)::BIGINT AS w24, coalesce(w1, 0)::BIGINT AS w1, dead_since AS d, probation AS p, now FROM e LEFT JOIN y USING (source) LEFT JOIN l USING (source), n),
    k AS (SELECT *, rows = 0 AND p IS NULL AND coalesce(d, now) <= now - INTERVAL 72 HOUR AS due FROM j)
    SELECT source, rows, w24, w1, CASE WHEN w24 > 0 THEN 'alive' WHEN rows > 0 THEN 'cooldown' ELSE 'dead-candidate' END AS state,
        CASE WHEN rows = 0 THEN coalesce(d, now) END AS dead_since, CASE WHEN rows = 0 THEN CASE WHEN due THEN now ELSE p END END AS probation, due FROM k""")
def source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lives of the event types and of three sources that yield nothing: one new, one dead for 80 hours, one on probation; a type that was dead yields again."""
    events = table(spark, sf_dir, "events")
    now = F.lit(events.agg(F.max("ts")).first()[0]).cast("timestamp")
    ago = lambda hours: now - F.expr(f"INTERVAL {hours} HOURS")
    idle = spark.createDataFrame([("idle_new",), ("idle_old",), ("idle_on_probation",)], "source string")
    last = spark.createDataFrame([("idle_old",), ("idle_on_probation",), ("click",)], "source string")
    lives = last.withColumn("dead_since", F.when(F.col("source") == "idle_old", ago(80)).when(F.col("source") == "click", ago(9)).otherwise(ago(200)))
    lives = lives.withColumn("probation", F.when(F.col("source") == "idle_on_probation", ago(100)))
    return gates.source_lives(events.select(F.col("event_type").alias("source")).union(idle), _windows(spark, sf_dir), lives, now)


@query("""
    SELECT event_type, user_id % 7 AS machine, count(*) AS n, count(DISTINCT user_id) AS users, sum(round(value * 100)::BIGINT)::BIGINT AS cents
    FROM events GROUP BY GROUPING SETS ((event_type, machine), (event_type), (machine), ())""")
def fleet_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 7).alias("machine"), "user_id", "value").createOrReplaceTempView("_fleet")
    return spark.sql("""
        SELECT event_type, machine, count(*) AS n, count(DISTINCT user_id) AS users, sum(CAST(round(value * 100) AS BIGINT)) AS cents
        FROM _fleet GROUP BY GROUPING SETS ((event_type, machine), (event_type), (machine), ())""")


@query("SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY CUBE (lang, source)")
def docs_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").cube("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def docs_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"))


@query("SELECT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, count(*) AS n_pages, avg(CASE WHEN starts_with(url, 'https') THEN 1 ELSE 0 END)::DOUBLE AS secure_share, median(length(html)) AS median_chars FROM pages GROUP BY 1")
def docs_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    secure = F.avg(F.col("url").startswith("https").cast("int"))
    return pages.groupBy(text.netloc(F.col("url")).alias("host")).agg(F.count("*").alias("n_pages"), secure.alias("secure_share"), F.median(F.length("html")).alias("median_chars"))


@query("SELECT source, median(n_chars) AS median_chars, quantile_cont(n_chars, 0.9) AS p90_chars FROM documents GROUP BY source")
def median_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.median("n_chars").alias("median_chars"), F.percentile("n_chars", 0.9).alias("p90_chars"))


@query("SELECT 1 - count(DISTINCT md5(text))::DOUBLE / count(*) AS dup_ratio FROM documents")
def dup_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").agg((1 - F.countDistinct(F.md5(F.col("text").cast("binary"))) / F.count("*")).alias("dup_ratio"))


@query("""
    WITH a AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1), b AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0)
    SELECT (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS both, (SELECT count(*) FROM (FROM a EXCEPT FROM b)) AS only_a, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS only_b""")
def coverage_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels")
    a, b = (docs.join(labels.where(c), "doc_id").select("source").distinct() for c in ("toxic = 1", "quality = 0"))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(a.intersect(b), "both").join(count(a.subtract(b), "only_a")).join(count(b.subtract(a), "only_b"))


@query("SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n FROM events GROUP BY 1")
def timeline_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))


@query("""
    SELECT event_type, day, n, coalesce(n - lag(n) OVER w <= 0, false) AS stalled, coalesce(restarts - lag(restarts) OVER w > 3, false) AS restarted
    FROM (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n, max(user_id % 10) AS restarts FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
def stall_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"), F.max(F.col("user_id") % 10).alias("restarts"))
    return stalls(days, "event_type", "day", "n", "restarts").drop("restarts")


@query("SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, least(100, count(*) * 100 // 80) AS progress FROM documents GROUP BY source ORDER BY n DESC, source")
def preview_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("lang").alias("langs"))
    return rows.withColumn("progress", F.least(F.lit(100), F.floor(F.col("n") * 100 / 80))).orderBy(F.desc("n"), "source")


@query("SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE list_contains([d.source, d.lang], 'src3') ORDER BY l.quality DESC NULLS LAST, d.doc_id")
def preview_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.array_contains(F.array("source", "lang"), "src3")).select("doc_id", "source")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").orderBy(F.desc_nulls_last("quality"), "doc_id")


@query("SELECT source, coalesce(a.n, 0) AS labelled, coalesce(b.n, 0) AS german FROM (SELECT source, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY source) a FULL JOIN (SELECT source, count(*) AS n FROM documents WHERE lang = 'de' GROUP BY source) b USING (source)")
def counts_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    a = docs.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id").groupBy("source").agg(F.count("*").alias("labelled"))
    b = docs.where("lang = 'de'").groupBy("source").agg(F.count("*").alias("german"))
    return a.join(b, "source", "full_outer").select("source", F.coalesce("labelled", F.lit(0)).alias("labelled"), F.coalesce("german", F.lit(0)).alias("german"))


@query("SELECT event_type, sum((props::JSON->>'k')::BIGINT)::BIGINT AS total, count(*) AS n FROM events GROUP BY event_type")
def json_prop_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS results, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.8) AS p80, quantile_cont(value, 0.95) AS p95, 100 - 100.0::DOUBLE * count(*) FILTER (WHERE event_type = 'purchase') / count(*) AS reliability FROM events GROUP BY user_id")
def engine_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lambda q, name: F.percentile("value", q).alias(name)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("results"), p(0.5, "p50"), p(0.8, "p80"), p(0.95, "p95"), (100 - 100.0 * F.count_if(F.col("event_type") == "purchase") / F.count("*")).alias("reliability")
    )


@query("""
    SELECT count(*) AS sampled, round(count(*) FILTER (WHERE n <= 1) / count(*)::DOUBLE, 2) AS shell_rate, round(avg(i), 1) AS avg_images, round(count(*) FILTER (WHERE n <= 1) / count(*)::DOUBLE, 2) > 0.4 AS alert
    FROM (SELECT len(string_split(text, chr(10))) AS n, doc_id % 5 AS i FROM documents)""")
def patrol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of documents of one passage, a line each here, their images, and whether so many shells set off an alert."""
    docs = table(spark, sf_dir, "documents").select(F.size(F.split("text", "\n")).alias("n_passages"), (F.col("doc_id") % 5).alias("n_images"))
    return alerts.patrol_stats(docs)


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def source_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


@query(f"""
    WITH y AS ({_W}) SELECT (SELECT count(*) FROM y) + 1 AS enabled, (SELECT count(*) FROM y WHERE w24 > 0) AS effective_24h, (SELECT count(*) FROM y WHERE w1 > 0) AS effective_1h, 1 AS dead_candidates""")
def source_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that a run adds to the trend of its sources: the event types and one that yields nothing."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"))
    lives = spark.createDataFrame([], "source string, dead_since timestamp, probation timestamp")
    now = F.lit("2024-02-01").cast("timestamp")
    enabled = events.union(spark.createDataFrame([("idle",)], "source string"))
    return alerts.trend(gates.source_lives(enabled, _windows(spark, sf_dir), lives, now))


@query("""
    WITH e AS (SELECT event_type AS source, user_id % 7 AS machine, user_id % 2 AS grp, value, epoch(now) - epoch(ts) AS age FROM events, (SELECT max(ts) AS now FROM events))
    SELECT source, machine, count(*) AS total, count(*) FILTER (WHERE age <= 86400) AS w24, count(*) FILTER (WHERE age <= 3600) AS w1, sum(round(value * 100)::BIGINT)::BIGINT AS units, round(count(*) FILTER (WHERE age <= 86400) / 24.0::DOUBLE, 2) AS per_hour,
        array_to_string(list_sort(list(DISTINCT grp::VARCHAR)), ',') AS groups FROM e GROUP BY GROUPING SETS ((source), (machine))""")
def fleet_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source and each machine has yielded: in all, in a day, in an hour, an hour on average, and for which groups."""
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now"))  # one row
    age = F.col("now").cast("timestamp").cast("double") - F.col("ts").cast("timestamp").cast("double")
    rows = events.join(F.broadcast(now)).select(F.col("event_type").alias("source"), (F.col("user_id") % 7).alias("machine"), (F.col("user_id") % 2).cast("string").alias("grp"), F.round(F.col("value") * 100).cast("long").alias("units"), age.alias("age"))
    return rows.groupingSets([["source"], ["machine"]], "source", "machine").agg(
        F.count("*").alias("total"), F.count_if(F.col("age") <= 86400).alias("w24"), F.count_if(F.col("age") <= 3600).alias("w1"), F.sum("units").alias("units"),
        F.round(F.count_if(F.col("age") <= 86400) / 24, 2).alias("per_hour"), F.array_join(F.array_sort(F.collect_set("grp")), ",").alias("groups"),
    )


@query("""
    SELECT lang, source, decile, count(*) AS n, sum(n_chars)::BIGINT AS bytes FROM (SELECT *, least((row_number() OVER (ORDER BY n_chars, doc_id) - 1) * 10 // count(*) OVER (), 9)::INT AS decile FROM documents) GROUP BY CUBE (lang, source, decile)""")
def class_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and sizes by language, source and decile of size, with all their subtotals."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    ranked = global_rank(docs, "n_chars", ["doc_id"], "r").withColumn("decile", decile(F.col("r"), docs.count()))
    return ranked.cube("lang", "source", "decile").agg(F.count("*").alias("n"), F.sum("n_chars").alias("bytes"))


@query("""
    SELECT quality AS tier, count(*) AS n, round(avg(n_chars) / 1024, 3)::DOUBLE AS avg_kb, sum(n_chars)::BIGINT AS total, sum(CASE WHEN n_chars > 4096 THEN 4096 ELSE n_chars END)::BIGINT AS capped_total FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def tier_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and sizes of each tier, and what they would sum up to with a cap."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.groupBy(F.col("quality").alias("tier")).agg(
        F.count("*").alias("n"), F.round(F.avg("n_chars") / 1024, 3).alias("avg_kb"), F.sum("n_chars").alias("total"), F.sum(F.least("n_chars", F.lit(4096))).alias("capped_total")
    )


@query("""
    SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS bytes, count(DISTINCT (doc_id, lang)) AS pairs, count(*) FILTER (WHERE n_chars < 500) || '/' || count(*) AS small FROM documents GROUP BY source ORDER BY bytes DESC, source LIMIT 15""")
def audit_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen sources of most bytes (a report's length), with the share of small documents."""
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("bytes"), F.countDistinct("doc_id", "lang").alias("pairs"), F.concat_ws("/", F.count_if(F.col("n_chars") < 500).cast("string"), F.count("*").cast("string")).alias("small")
    )
    return rows.orderBy(F.desc("bytes"), "source").limit(15)


@query("""
    SELECT user_id, count(*) FILTER (WHERE value >= 10 AND user_id % 3 <> 0) AS got, (user_id % 4 = 0 AND user_id % 3 <> 0) AS free, concat_ws(',', CASE WHEN user_id % 2 = 0 THEN 'a' END, 'b') AS plan, greatest(0.1, (user_id % 10) / 4.0)::DOUBLE AS rate FROM events GROUP BY user_id""")
def worker_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each user as a worker: what passed the gate, whether memory is short, which sources are planned, and its share of a rate."""
    u = F.col("user_id")
    passed = gates.quality_gate(F.col("value"), u % 3 != 0, 10.0)
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(passed).alias("got"))
    plan = control.planned_sources(F.when(u % 2 == 0, F.array(F.lit("a"), F.lit("x"), F.lit("b"))).otherwise(F.array(F.lit("x"))), ("a", "b"), ("b",))
    short = memory_breach(F.when(u % 4 == 0, 130).otherwise(100), F.lit(100), F.lit(900.0)) & (u % 3 != 0)
    share = control.rate_share((u % 10).cast("double"), F.lit(8), F.lit(4))
    return rows.select("user_id", "got", short.alias("free"), F.array_join(plan, ",").alias("plan"), share["rate"].alias("rate"))


@query("""
    SELECT page_id, page_id % 4 IN (0, 1) AS side, page_id % 3 = 0 AS broken, page_id % 2 = 0 AS said FROM pages""")
def fetch_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images large enough, bodies that are errors, snippets long enough."""
    n = F.col("page_id")
    body = F.when(n % 3 == 0, F.when(n % 2 == 0, "").otherwise(" <!DOCTYPE html>")).otherwise("GIF89a").cast("binary")
    return table(spark, sf_dir, "pages").select(
        "page_id", gates.least_side(F.when(n % 4 != 3, 300), F.when(n % 4 == 2, 100).otherwise(200)).alias("side"), gates.error_body(body).alias("broken"), gates.snippet_gate(F.when(n % 2 == 0, F.repeat(F.lit("x"), F.lit(30))).otherwise("x" * 29)).alias("said")
    )


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256(text), doc_id) AS r FROM documents WHERE n_chars > 300 AND doc_id % 5 <> 0) WHERE r <= 40")
def cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forty blobs (the feature) that may go: verified and old, by digest."""
    d = F.col("doc_id")
    now = F.lit("2024-01-03").cast("timestamp")
    at = F.when(F.col("n_chars") > 300, F.lit("2024-01-01")).otherwise("2024-01-02 12:00:00").cast("timestamp")
    blobs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.sha2("text", 256), F.lpad(d.cast("string"), 12, "0")).alias("sha256"), at.alias("published_at"), (d % 5 != 0).alias("verified"), F.lit(False).alias("deleted"))
    return control.cleanup_eligible(blobs, now, 40).select("doc_id")


@query("SELECT event_type, count(*) AS judged, count(*) FILTER (WHERE value >= 10) AS accepted FROM events GROUP BY event_type")
def judged_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many picks a judge accepted: those among the candidates, whatever their case."""
    pick = control.judged(F.when(F.col("value") >= 10, F.upper("event_type")).otherwise("other"), F.array(F.col("event_type"), F.lit("x")))
    return table(spark, sf_dir, "events").withColumn("pick", pick).groupBy("event_type").agg(F.count("*").alias("judged"), F.count_if(F.col("pick") == "accepted").alias("accepted"))
