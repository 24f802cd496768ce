"""Trees and registries of paths over parts and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import control, trees

from .catalogue import query, table

_LEVELS = ("split_part(p_name, ' ', 2)", "p_type", "split_part(p_name, ' ', 1)", "p_brand")
_PATHS = ["'/' || " + " || '/' || ".join(_LEVELS[:i]) for i in range(1, len(_LEVELS) + 1)]
_EDGES = " UNION ".join(f"SELECT {'NULL' if i == 0 else _PATHS[i - 1]} AS parent, {p} AS node, {level} AS position FROM part" for i, (p, level) in enumerate(zip(_PATHS, _LEVELS, strict=True)))


@query(f"""
    WITH RECURSIVE e AS (SELECT coalesce(parent, '') AS parent, node, position FROM ({_EDGES})),
    t AS (SELECT '' AS node, 0 AS depth, '' AS branch, []::VARCHAR[] AS place UNION ALL SELECT e.node, t.depth + 1, CASE WHEN t.depth < 2 THEN e.node ELSE t.branch END, list_append(t.place, e.position) FROM t JOIN e ON e.parent = t.node),
    m AS (SELECT {_PATHS[3]} AS node, 's' || p_size AS instance, p_partkey AS position FROM part UNION ALL SELECT {_PATHS[1]}, 's' || p_size, p_partkey FROM part WHERE p_size % 7 = 0)
    SELECT instance, node, depth, branch FROM (SELECT *, row_number() OVER (PARTITION BY instance ORDER BY place, position, node) AS r FROM t JOIN m USING (node)) WHERE r = 1""")
def tree_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The branch of each size of part in a tree of four levels made of the parts' names, types and brands: the first mount on a walk of the tree, some of them half way down."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    levels = [word(2), F.col("p_type"), word(1), F.col("p_brand")]
    paths = [F.concat(F.lit("/"), F.concat_ws("/", *levels[:i])) for i in range(len(levels) + 1)]
    paths[0] = F.lit("")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name", "p_type", "p_brand")
    edges = parts.select(F.explode(F.array(*[F.struct(paths[i].alias("parent"), paths[i + 1].alias("node"), x.alias("position")) for i, x in enumerate(levels)])).alias("e")).select("e.*").distinct()
    size = F.concat(F.lit("s"), "p_size").alias("instance")
    mounts = parts.select(paths[4].alias("node"), size, F.col("p_partkey").alias("position")).unionByName(parts.where("p_size % 7 = 0").select(paths[2].alias("node"), size, F.col("p_partkey").alias("position")))
    walked = trees.walk_tree(edges, "")
    return trees.first_mounts(walked, mounts).join(walked.select("node", "depth"), "node").select("instance", "node", "depth", "branch")


@query("SELECT DISTINCT '/' || split_part(p_name, ' ', 2) || '/' || p_type AS branch FROM part")
def path_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The branches, two levels down, of paths of four."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    path = F.concat(F.lit("/"), F.concat_ws("/", word(2), "p_type", word(1), "p_brand"))
    return table(spark, sf_dir, "part").select(control.branch_of(path).alias("branch")).distinct()


@query("""
    WITH n AS (SELECT left('O' || o_orderkey * 37 % 100000, (o_orderkey % 6 + 2)::INT) AS node, max(o_orderpriority) AS target FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1),
    p AS (SELECT c_custkey, CASE WHEN c_custkey % 50 <> 0 THEN left('O' || c_custkey * 91 % 100000, (c_custkey % 7 + 1)::INT) END AS path FROM customer)
    SELECT c_custkey, path, node, target FROM p LEFT JOIN n ON starts_with(path, node) OR starts_with(node, path) QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY length(node) DESC, node DESC) = 1""")
def registry_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' paths routed by a table of nodes, orders, without a list in the plan."""
    o, c = F.col("o_orderkey"), F.col("c_custkey")
    head = lambda n, k: F.substring(F.concat(F.lit("O"), n.cast("string")), F.lit(1), k.cast("int"))
    nodes = table(spark, sf_dir, "orders").where(o % 3 == 0).select(head(o * 37 % 100000, o % 6 + 2).alias("node"), F.col("o_orderpriority").alias("target"))
    paths = table(spark, sf_dir, "customer").select("c_custkey", F.when(c % 50 != 0, head(c * 91 % 100000, c % 7 + 1)).alias("path"))
    return trees.prefix_join(paths, "path", nodes)
