"""Ledgers: first-wins merge, coverage, quotas, resuming, strides, routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import control, gates
from cairn.operators.relational import append_new, batches, decile, first_wins, global_rank, index_percentiles, prefix_route, stride_shard

from .catalogue import folder, query, table


@query("SELECT doc_id, sha2, source FROM (SELECT doc_id, sha256(text) AS sha2, source FROM documents) QUALIFY row_number() OVER (PARTITION BY sha2, source ORDER BY doc_id) = 1")
def merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha2"), "source")
    return first_wins(docs, ["sha2", "source"], ["doc_id"])


@query("SELECT doc_id, text_key FROM (SELECT doc_id, md5(text) AS text_key FROM documents) d WHERE text_key NOT IN (SELECT md5(text) FROM documents WHERE lang = 'en') QUALIFY row_number() OVER (PARTITION BY text_key ORDER BY doc_id) = 1")
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sink appends to a ledger that holds the English documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("text_key"))
    return append_new(docs.where("lang = 'en'").select("text_key"), docs.select("doc_id", "text_key"), ["text_key"], ["doc_id"])


@query("""
    SELECT s.source, count(l.doc_id)::BIGINT AS got FROM (SELECT DISTINCT source FROM documents) s
    LEFT JOIN documents d ON s.source = d.source LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.quality >= 1 AND l.toxic = 0 GROUP BY s.source""")
def coverage_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels")
    passed = labels.where(gates.quality_gate(F.col("quality"), F.col("toxic") == 0, 1)).select("doc_id")
    counts = docs.join(passed, "doc_id").groupBy("source").agg(F.count("*").alias("got"))
    return docs.select("source").distinct().join(counts, "source", "left").select("source", F.coalesce("got", F.lit(0)).alias("got"))


_STARVED = """
    WITH got AS (SELECT d.source AS name, count(*) AS got FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 GROUP BY 1),
    t AS (SELECT DISTINCT source AS name, lang AS branch, 16 + length(source) AS quota FROM documents),
    s AS (SELECT t.name, t.branch, coalesce(g.got, 0)::BIGINT AS got, t.quota::INT AS quota FROM t LEFT JOIN got g USING (name) WHERE coalesce(g.got, 0) < t.quota)"""


def _starved(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    got = docs.join(labels, "doc_id").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("got"))
    targets = docs.select(F.col("source").alias("name"), F.col("lang").alias("branch")).distinct().withColumn("quota", (16 + F.length("name")).cast("int"))
    rows = targets.join(got, "name", "left").select("name", "branch", F.coalesce("got", F.lit(0)).alias("got"), "quota")
    return rows.where(F.col("got") < F.col("quota"))


@query(_STARVED + " SELECT * FROM s ORDER BY got, name, branch LIMIT 30")
def starvation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30 concepts that lack most (a report's length)."""
    return _starved(spark, sf_dir).orderBy("got", "name", "branch").limit(30)


@query(_STARVED + " SELECT branch, count(*) AS starved FROM s GROUP BY branch ORDER BY starved DESC, branch LIMIT 10")
def starved_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _starved(spark, sf_dir).groupBy("branch").agg(F.count("*").alias("starved")).orderBy(F.desc("starved"), "branch").limit(10)


@query(_STARVED + " SELECT (SELECT count(*) FROM t) AS concepts, (SELECT count(*) FROM s) AS starved, round((SELECT count(*) FROM s) / greatest((SELECT count(*) FROM t), 1), 3)::DOUBLE AS starved_ratio")
def starved_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many concepts get less than their quota, of all."""
    starved = _starved(spark, sf_dir).agg(F.count("*").alias("starved"))
    every = table(spark, sf_dir, "documents").select("source", "lang").distinct().agg(F.count("*").alias("concepts"))
    return every.join(starved).select("concepts", "starved", F.round(F.col("starved") / F.greatest("concepts", F.lit(1)), 3).alias("starved_ratio"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 UNION SELECT doc_id FROM labels WHERE toxic = 1)")
def anti_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    skip = labels.where("quality = 1").select("doc_id").union(labels.where("toxic = 1").select("doc_id")).distinct()
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(skip, "doc_id", "left_anti")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS r FROM documents) WHERE r % 7 = 3")
def shard_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stride_shard(global_rank(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", ["doc_id"], "r"), "r", 3, 7).select("doc_id")


@query("SELECT doc_id, source FROM documents ORDER BY md5(doc_id || ':7'), doc_id LIMIT 50")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty documents for a check by hand, the same in every run with this seed."""
    return control.seeded_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 7, 50)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || ':11'), o_orderkey) - 1 AS place FROM orders")
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in an order that only the seed decides."""
    return control.seeded_order(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 11, "place")


@query("SELECT r // 50 AS batch, list(doc_id ORDER BY r) AS items FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS r FROM documents) GROUP BY 1")
def batches_of_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches(global_rank(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", ["doc_id"], "r"), "r", 50, "doc_id")


@query("""
    SELECT least(r * 10 // n, 9)::INT AS decile, lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS chars
    FROM (SELECT *, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS r, count(*) OVER () AS n FROM documents) GROUP BY 1, 2""")
def ledger_decile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    ranked = global_rank(docs, "n_chars", ["doc_id"], "r").withColumn("decile", decile(F.col("r"), docs.count()))
    return ranked.groupBy("decile", "lang").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("chars"))


@query("SELECT max(n_chars) FILTER (WHERE r = floor(n * 0.5)) AS p50, max(n_chars) FILTER (WHERE r = floor(n * 0.9)) AS p90, max(n_chars) FILTER (WHERE r = floor(n * 0.99)) AS p99 FROM (SELECT n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)")
def size_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_percentiles(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", ["doc_id"], {"p50": 0.5, "p90": 0.9, "p99": 0.99})


NODES = [("STANDARD", "general"), ("STANDARD ANODIZED", "metal"), ("STANDARD ANODIZED TIN", "tin"), ("PROMO", "offers"), ("ECONOMY PLATED", "plated"), ("ECO", "green"), ("LARGE", "bulk"), ("MEDIUM POLISHED", "polished")]


@query(f"""
    SELECT p_partkey, p_type, n.node, n.target FROM part LEFT JOIN (VALUES {', '.join(map(str, NODES))}) n(node, target) ON starts_with(p_type, n.node) OR starts_with(n.node, p_type)
    QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(n.node) DESC, n.node DESC) = 1""")
def prefix_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_route(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", NODES)


@query("""
    SELECT source, n, n >= 60 AS covered FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)""")
def covered_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts with their coverage; the uncovered come first when a run takes them up."""
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return counts.withColumn("covered", F.col("n") >= 60).orderBy("covered", "source")


@query("SELECT doc_id, (doc_id % 5)::INT AS kb, (doc_id % 7)::INT AS focus, (doc_id % 11)::INT AS rich, round((4 * (doc_id % 5) + 4 * (doc_id % 7) + 2 * (doc_id % 11)) / 10, 1)::DOUBLE AS quality FROM documents")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda n: (F.col("doc_id") % n).cast("int")
    rows = table(spark, sf_dir, "documents").select("doc_id", part(5).alias("kb"), part(7).alias("focus"), part(11).alias("rich"))
    return rows.withColumn("quality", text.quality_score(F.col("kb"), F.col("focus"), F.col("rich")))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'skip' WHEN o_orderpriority = '1-URGENT' THEN 'net:timeout' WHEN o_totalprice > 300000 THEN 'capped' WHEN o_custkey % 9 = 0 THEN 'sha_mismatch' ELSE 'done' END AS outcome FROM orders")
def backfill_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("o_orderpriority") == "1-URGENT", "timeout")
    sha = F.when(F.col("o_custkey") % 9 == 0, "other").otherwise("same")
    outcome = gates.backfill_outcome(F.col("o_orderstatus") == "F", F.lit(False), error, F.col("o_totalprice"), 300_000, sha, F.lit("same"))
    return table(spark, sf_dir, "orders").select("o_orderkey", outcome.alias("outcome"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS r FROM documents) WHERE r >= 7 AND (r - 7) % 3 = 1 AND (r - 7) // 3 < 40")
def stride_with_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stride of three over the documents by size, after an offset of seven, forty of them (both are the feature)."""
    ranked = global_rank(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", ["doc_id"], "r")
    return stride_shard(ranked, "r", 1, 3, offset=7, limit=40, before=True).select("doc_id")


@query("""
    WITH n AS (SELECT source, count(*) AS n, least(count(*), 60) AS c FROM documents GROUP BY source)
    SELECT pass, source FROM n, (SELECT unnest([1, 2, 3, 4]) AS pass) WHERE n.c > (pass - 1) * 20""")
def passes_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources that each of at most four passes still takes up, until each has as many documents as it can have: a pass brings twenty."""
    counts = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n"))
    wanted = counts.select("name", F.least("n", F.lit(60)).alias("quota"))
    path = folder(spark, "passes")
    wanted.limit(0).select("name", F.lit(0).alias("pass")).write.parquet(path)
    done = 0

    def collect(short: DataFrame) -> None:
        nonlocal done
        done += 1
        short.select("name", F.lit(done).alias("pass")).write.mode("append").parquet(path)

    def coverage() -> DataFrame:
        return spark.read.parquet(path).groupBy("name").agg((F.count("*") * 20).alias("n"))

    control.retry_until_covered(collect, coverage, wanted, 4)
    return spark.read.parquet(path).select("pass", F.col("name").alias("source"))
