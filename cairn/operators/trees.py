"""Trees and registries of paths as tables: walks level by level, longest prefixes by equality joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.sources.sinks import shared_folder

from .relational import free_name


def walk_tree(edges: DataFrame, root: str, branch_depth: int = 2, most: int = 1000) -> DataFrame:
    """(node, depth, branch, place) of the nodes reached from `root` over edges (parent, node, position).

    `branch` is the node's ancestor at `branch_depth`, itself where it is no deeper; `place` is the positions of
    the way down, an array whose order is that of a walk that takes a node before its children, and these by position.
    A node with several parents comes once for each way. Each level is a join of the last one with the edges and is
    written to the shared folder; only whether it has rows reaches the driver. A way of more than `most` levels, as a circle makes, is an error.
    """
    spark, path = edges.sparkSession, shared_folder(edges.sparkSession, "tree")
    kind = edges.schema["position"].dataType.simpleString()
    node = edges.schema["node"].dataType.simpleString()
    edges = edges.select(F.col("parent").alias("_parent"), F.col("node").alias("_node"), F.col("position").alias("_position"))
    level = spark.range(1).select(F.lit(root).cast(node).alias("node"), F.lit(0).alias("depth"), F.lit(root).cast(node).alias("branch"), F.array().cast(f"array<{kind}>").alias("place"))
    for depth in range(most + 1):
        level.write.parquet(f"{path}/level={depth}")
        last = spark.read.parquet(f"{path}/level={depth}")
        if last.isEmpty():
            return spark.read.schema(last.schema).parquet(path).select(*last.columns)
        branch = F.col("_node") if depth + 1 <= branch_depth else F.col("branch")
        level = last.join(edges, F.col("node") == F.col("_parent")).select(
            F.col("_node").alias("node"), F.lit(depth + 1).alias("depth"), branch.alias("branch"), F.concat("place", F.array("_position")).alias("place")
        )
    raise ValueError(f"ways of more than {most} levels: the edges go in a circle")


def first_mounts(walked: DataFrame, mounts: DataFrame) -> DataFrame:
    """(instance, node, branch) of instances mounted at nodes (node, instance, position): the first mount in the order of the walk wins."""
    at = mounts.select(F.col("node").alias("_at"), "instance", F.col("position").alias("_position"))
    rows = walked.join(at, F.col("node") == F.col("_at"))
    first = rows.groupBy("instance").agg(F.min_by(F.struct("node", "branch"), F.struct("place", "_position", "node")).alias("_m"))
    return first.select("instance", "_m.*")


def prefix_join(paths: DataFrame, path: str, nodes: DataFrame) -> DataFrame:
    """Add `node` and `target` of the longest node that is a prefix of the path or of which the path is a prefix; of equally long ones the greatest; nulls where none is.

    `nodes` is a table (node, target). Each distinct path is expanded to its prefixes of the lengths that nodes
    have, each node to all of its prefixes, and both are joined by equality. A path that is a prefix of a node counts as
    fitting it, and such a node is no shorter than any that is a prefix of the path. What the driver gets are the distinct lengths of nodes.
    """
    node, target, key, rank = (free_name(paths, x) for x in ("node_", "target_", "path_", "fit_"))
    best = F.max_by(F.struct("node", "target"), F.struct(F.length("node"), "node"))
    nodes = nodes.where("node IS NOT NULL").groupBy("node").agg(F.max("target").alias("target"))
    lengths = sorted(r[0] for r in nodes.select(F.length("node")).distinct().collect())
    known = paths.select(F.col(path).alias(key)).where(F.col(path).isNotNull()).distinct()
    heads = known.select(key, F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias("_n")).where(F.col("_n") <= F.length(key))
    above = heads.select(key, F.substring(F.col(key), F.lit(1), F.col("_n")).alias("_head")).join(nodes, F.col("_head") == F.col("node")).select(key, "node", "target", F.lit(0).alias(rank))
    starts = nodes.select("node", "target", F.explode(F.sequence(F.lit(0), F.length("node"))).alias("_n"))
    starts = starts.groupBy(F.substring(F.col("node"), F.lit(1), F.col("_n")).alias("_head")).agg(best.alias("_b"))
    below = known.join(starts, F.col(key) == F.col("_head")).select(key, "_b.node", "_b.target", F.lit(1).alias(rank))
    found = above.unionByName(below).groupBy(key).agg(F.max_by(F.struct("node", "target"), F.struct(F.length("node"), "node")).alias("_b"))
    found = found.select(key, F.col("_b.node").alias(node), F.col("_b.target").alias(target))
    joined = paths.drop("node", "target").join(found, F.col(path) == F.col(key), "left").drop(key)
    return joined.withColumnsRenamed({node: "node", target: "target"})
