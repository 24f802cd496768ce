"""The manifest of files to fetch: semi joins, rank dedup, quota, anti join, size filter, grouping.

Stand-ins: lineitem for edges (part: concept, order: media id, return flag: rank), orders
for files (name: priority and key; size: total price; status P: already held), part for
the concept set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.operators.relational import group_to_list, rank_best_then_quota, top_n_per_key

from .catalogue import query, table

QUOTA, LEAST, MOST = 30, 50_000, 400_000
PRIORITY = "CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


def stages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    concepts = table(spark, sf_dir, "part").where("p_size <= 40").select(F.col("p_partkey").alias("qid"))
    edges = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("qid"), F.col("l_orderkey").alias("mid"), F.col("l_returnflag").alias("rank"), F.col("l_linenumber").alias("line"), F.expr(PRIORITY).alias("prio")
    )
    files = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("mid"), F.concat_ws("-", "o_orderpriority", "o_orderkey").alias("fname"), F.col("o_totalprice").alias("size"), F.col("o_orderstatus").alias("status")
    )
    hit = edges.join(concepts, "qid", "left_semi")
    named = hit.join(files.select("mid", "fname"), "mid")
    quota = rank_best_then_quota(named, "qid", "fname", F.col("prio"), ["mid", "line"], ["mid", "rank"], QUOTA)
    wanted = quota.join(files.where("status = 'P'").select("fname"), "fname", "left_anti")
    sized = wanted.join(files.where(F.col("size").between(LEAST, MOST)).select("fname", "size"), "fname")
    return {"edges": edges, "hit": hit, "named": named, "quota": quota, "wanted": wanted, "sized": sized}


_CTE = f"""
    WITH hit AS (SELECT l_partkey AS qid, l_orderkey AS mid, l_returnflag AS rank, l_linenumber AS line,
            CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS prio FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)),
    f AS (SELECT o_orderkey AS mid, o_orderpriority || '-' || o_orderkey AS fname, o_totalprice AS size, o_orderstatus AS status FROM orders),
    named AS (SELECT h.*, f.fname FROM hit h JOIN f USING (mid)),
    best AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY qid, fname ORDER BY prio, mid, line) = 1),
    quota AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY qid ORDER BY fname) <= {QUOTA}),
    wanted AS (SELECT * FROM quota WHERE fname NOT IN (SELECT fname FROM f WHERE status = 'P')),
    sized AS (SELECT w.*, f.size FROM wanted w JOIN f USING (fname) WHERE f.size BETWEEN {LEAST} AND {MOST})"""


@query(
    _CTE
    + """
    SELECT fname, arg_min(mid, qid) AS mid, string_agg(qid || ':' || rank, ',' ORDER BY qid) AS pairs, min(size) AS size FROM sized GROUP BY fname"""
)
def sdc_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stages(spark, sf_dir)["sized"]
    return group_to_list(sized, "fname", ["qid"], F.concat_ws(":", "qid", "rank"), "mid", F.min("size").alias("size"))


@query(
    _CTE
    + """
    SELECT (SELECT count(*) FROM lineitem) AS edges, (SELECT count(*) FROM hit) AS hit, (SELECT count(*) FROM best) AS best, (SELECT count(*) FROM quota) AS quota,
        (SELECT count(*) FROM wanted) AS wanted, (SELECT count(*) FROM sized) AS sized, (SELECT count(DISTINCT fname) FROM sized) AS files, (SELECT count(DISTINCT qid) FROM sized) AS concepts,
        (SELECT sum(CAST(round(size) AS BIGINT))::BIGINT FROM sized) AS bytes_edges, (SELECT sum(CAST(round(size) AS BIGINT))::BIGINT FROM (SELECT DISTINCT fname, size FROM sized)) AS bytes_files"""
)
def sdc_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows, files and bytes each stage leaves, in one pass over the edges and one over the best edges of each file."""
    concepts = table(spark, sf_dir, "part").where("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("hit"))
    edges = table(spark, sf_dir, "lineitem").select("l_partkey").join(concepts, "l_partkey", "left").agg(F.count("*").alias("edges"), F.count("hit").alias("hit"))
    best = stages(spark, sf_dir)["named"].select("qid", "fname").distinct()
    place = F.row_number().over(Window.partitionBy("qid").orderBy("fname"))
    files = table(spark, sf_dir, "orders").select(
        F.concat_ws("-", "o_orderpriority", "o_orderkey").alias("fname"), F.col("o_totalprice").alias("size"), (F.col("o_orderstatus") == "P").alias("held")
    )
    rows = best.withColumn("quota", place <= QUOTA).join(files, "fname")
    wanted = F.col("quota") & ~F.col("held")
    rows = rows.withColumns({"wanted": wanted, "sized": wanted & F.col("size").between(LEAST, MOST), "bytes": F.round("size").cast("long")})
    by_file = rows.groupBy("fname").agg(
        F.count("*").alias("best"), *[F.count_if(F.col(c)).alias(c) for c in ("quota", "wanted", "sized")], F.max("bytes").alias("bytes"), F.collect_set(F.when(F.col("sized"), F.col("qid"))).alias("qids")
    )
    sums = by_file.agg(
        *[F.sum(c).alias(c) for c in ("best", "quota", "wanted", "sized")], F.count_if(F.col("sized") > 0).alias("files"),
        F.sum(F.col("sized") * F.col("bytes")).alias("bytes_edges"), F.sum(F.when(F.col("sized") > 0, F.col("bytes"))).alias("bytes_files"),
    )
    found = by_file.select(F.explode("qids").alias("qid")).distinct().agg(F.count("*").alias("concepts"))
    return edges.join(sums).join(found)  # one row each


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) <= 10")
def quota30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_per_key(table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber"), ["l_partkey"], ["l_orderkey", "l_linenumber"], 10)


@query("SELECT l_orderkey, arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS l_suppkey, string_agg(l_partkey || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS pairs FROM lineitem GROUP BY l_orderkey")
def group_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_to_list(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], F.concat_ws(":", "l_partkey", "l_returnflag"), "l_suppkey")


@query("SELECT count(*) AS missing FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 40)")
def edges_without_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    concepts = table(spark, sf_dir, "part").where("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf_dir, "lineitem").select("l_partkey").join(concepts, "l_partkey", "left_anti").agg(F.count("*").alias("missing"))


@query("""
    SELECT c_custkey, coalesce(list_sort(list(o_orderkey) FILTER (WHERE o_orderstatus = 'F')), []) AS finished, coalesce(list_sort(list(o_orderkey) FILTER (WHERE o_orderstatus = 'O')), []) AS open
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def enrich_left_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of collected properties beside every concept; none: an empty array."""
    orders = table(spark, sf_dir, "orders")
    of = lambda status, name: F.array_sort(F.collect_list(F.when(F.col("o_orderstatus") == status, F.col("o_orderkey")))).alias(name)
    props = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(of("F", "finished"), of("O", "open"))
    none = F.array().cast("array<bigint>")
    return table(spark, sf_dir, "customer").select("c_custkey").join(props, "c_custkey", "left").select(
        "c_custkey", F.coalesce("finished", none).alias("finished"), F.coalesce("open", none).alias("open")
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25) AS in_corpus FROM lineitem")
def edge_in_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("_in"))
    edges = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return edges.join(corpus, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("_in", F.lit(False)).alias("in_corpus"))
