"""Connected components of a graph given as a table of edges, as a loop of Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(edges.select(F.col("m").alias("u"), "v"))


#: Edges of a partition between two shuffles, about, and the least such partitions.
EDGES, LEAST = 1 << 18, 8


def _stars(directed: DataFrame, parts: int) -> DataFrame:
    """Rows (u, v, m): m is the least of u and all v beside it. The minimum is pre-aggregated, so a hub moves little."""
    least = directed.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("hub"), F.least("u", "w").alias("m"))
    return directed.join(least, F.col("u") == F.col("hub")).select("u", "v", "m").coalesce(parts)


#: So many distinct edges, 64 bytes each or so, are one task's work; more take the steps.
FEW = 1 << 20


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all edges (v, m) of a task."""
    up: dict = {}

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for v, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(up.setdefault(v, v)), root(up.setdefault(m, m))
            if a != b:
                up[max(a, b)] = min(a, b)
    if up:
        nodes = list(up)
        for i in range(0, len(nodes), 10_000):
            part = nodes[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], ["node", "root"])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge between two different nodes; root: the least node of its component.

    Large-star and small-star steps alternate until the edges form stars around the
    roots: each step hangs neighbours on the least node known, and the number of steps
    grows with the logarithm of the component's size. Every step is written to the
    checkpoint folder. Rows with a null end and loops are ignored; an empty table
    gives an empty result. A graph of FEW edges or fewer takes one task in place of the steps. Between shuffles edges lie in partitions by their number, so that many
    steps over a small graph leave few small files.
    """
    edges = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).where((F.col(a) != F.col(b)))
    edges = materialize(edges.distinct())
    state, n = None, edges.count()
    if n <= FEW:
        kind = edges.schema["v"].dataType.simpleString()
        return materialize(edges.select("v", "m").coalesce(1).mapInArrow(_united, f"node {kind}, root {kind}"))
    while True:
        parts = max(LEAST, -(-n // EDGES))
        large = _stars(_both(edges.coalesce(parts)), parts).where(F.col("v") > F.col("u")).select("v", "m").where("v != m").distinct().coalesce(parts)
        down = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _stars(down, parts)
        small = small.select("v", "m").unionByName(small.select(F.col("u").alias("v"), "m")).where("v != m").distinct()
        edges = materialize(small.coalesce(parts))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state, n = now, now[0]
    roots = edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(roots)
