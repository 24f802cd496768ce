"""Sinks: idempotent ledgers, whole-table replacement, results for export."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.relational import append_new


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder. Where none is set, a local session gets a temporary one; on a cluster that is an error."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir")
    if shared is None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='cairn-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ledger_or_empty(df: DataFrame, path: str) -> DataFrame:
    """The Parquet ledger at `path`, or an empty one with the columns of `df` where there is none yet."""
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return df.limit(0)


def append_manifest(df: DataFrame, path: str, keys: list[str], order: list[str], required: tuple[str, ...] = ()) -> None:
    """Append the rows whose key the ledger lacks, the first of each; rows with a null or blank key or required column are refused. Running it again appends nothing."""
    full = lambda c: (F.trim(F.col(c)) != "") if df.schema[c].dataType.simpleString() == "string" else F.col(c).isNotNull()
    complete = df.where(reduce(lambda a, b: a & b, map(full, [*keys, *required])))
    append_new(ledger_or_empty(df, path), complete, keys, order).write.mode("append").parquet(path)


def append_outcomes(df: DataFrame, outcome: str, done: str, dead: str, keys: list[str], order: list[str]) -> None:
    """Two ledgers of one pass: rows with outcome `done`, and dead letters with their reason; `skip` rows go to neither and come again.

    Each ledger takes a key once, so a pass that is run again, or broke off between the two, adds nothing twice.
    """
    append_manifest(df.where(F.col(outcome) == "done").drop(outcome), done, keys, order)
    append_manifest(df.where(~F.col(outcome).isin("done", "skip")).withColumnRenamed(outcome, "reason"), dead, keys, order)


def _paths(df_or_spark, *names: str):
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    jvm = spark._jvm.org.apache.hadoop.fs
    paths = [jvm.Path(n) for n in names]
    return paths[0].getFileSystem(spark._jsc.hadoopConfiguration()), *paths


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a table by one that may be derived from it.

    The new one is written beside it, then the old one is set aside, the new one takes its
    place, and the old one goes. A break between the two renames leaves the old one whole
    under `path`.old: `recover_table` brings it back, and the next replacement does so first.
    """
    path = path.rstrip("/")
    staged, aside = f"{path}.{uuid.uuid4().hex}", f"{path}.old"
    df.write.parquet(staged)
    recover_table(df.sparkSession, path)
    fs, target, source, old = _paths(df, path, staged, aside)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {path} to {aside}")
    if not fs.rename(source, target):
        fs.rename(old, target)
        raise OSError(f"cannot move {staged} to {path}")
    fs.delete(old, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish or take back a replacement that broke off: without a table the one set aside returns, else it goes."""
    fs, target, old = _paths(spark, path.rstrip("/"), f"{path.rstrip('/')}.old")
    if not fs.exists(old):
        return
    if fs.exists(target):
        fs.delete(old, True)
    elif not fs.rename(old, target):
        raise OSError(f"cannot bring {path} back")


def put_in_place(spark: SparkSession, folder: str, path: str) -> None:
    """Make the only file that Spark wrote into a folder the file at `path`, in the place of one that is there."""
    fs, source, target = _paths(spark, folder, path)
    parts = [f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} has {len(parts)} files")
    fs.delete(target, False)
    if not fs.rename(parts[0], target):
        raise OSError(f"cannot move {parts[0]} to {path}")


def split_pairs(df: DataFrame, pairs: str) -> DataFrame:
    """One row for each of the "qid:rank,qid:rank" pairs of a row: the other columns, `qid` and `rank`; blank pairs give none."""
    rest = [c for c in df.columns if c != pairs]
    each = df.select(*rest, F.explode(F.split(F.coalesce(pairs, F.lit("")), ",")).alias("_pair")).where("_pair <> ''")
    return each.select(*rest, F.substring_index("_pair", ":", 1).alias("qid"), F.when(F.col("_pair").contains(":"), F.substring_index("_pair", ":", -1)).alias("rank"))


#: The columns of an export, and the kinds of rows in the order they come.
EXPORT, KINDS = ("title", "url", "content", "host", "engine", "score"), ("result", "answer", "suggestion", "correction")


def export_rows(results: DataFrame, **others: DataFrame) -> DataFrame:
    """Results and, if given, answers, suggestions and corrections as rows of one export: the columns of EXPORT, `type` and its rank; missing columns are null."""
    out = None
    for rank, kind in enumerate(KINDS):
        df = results if kind == "result" else others.get(f"{kind}s")
        if df is None:
            continue
        part = df.select(*[F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in EXPORT], F.lit(kind).alias("type"), F.lit(rank).alias("type_rank"))
        out = part if out is None else out.unionByName(part)
    return out
