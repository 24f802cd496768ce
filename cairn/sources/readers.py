"""Readers of ledgers, tables, dumps and payloads as DataFrames with given schemas."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.functions import text
from cairn.operators.relational import first_wins


def manifest(spark: SparkSession, path: str, schema: str, corrupt: str | None = None) -> DataFrame:
    """JSON lines, gzip or plain; blank lines are skipped, malformed ones dropped, or kept whole in the column `corrupt`. `file` and `pos` give the order."""
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("pos"))
    mark = corrupt or "_bad"
    rows = lines.select(F.from_json("value", f"{schema}, {mark} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": mark}).alias("r"), "file", "pos").select("r.*", "file", "pos")
    return rows if corrupt else rows.where(F.col(mark).isNull()).drop(mark)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated rows without quoting; gzip by its suffix."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("escape", "").csv(path)


def triples(spark: SparkSession, path: str, predicates: list[str]) -> DataFrame:
    """(qid, prop, value) of N-triples whose predicate is listed; lines are filtered before they are parsed."""
    pattern = "^<[^>]*/entity/(Q\\d+)> <[^>]*/direct/(P\\d+)> (.+) \\.\\s*$"
    lines = spark.read.text(path).where(F.col("value").rlike("/direct/(" + "|".join(predicates) + ")>"))
    part = lambda i: F.regexp_extract("value", pattern, i)
    return lines.select(part(1).alias("qid"), part(2).alias("prop"), text.triple_value(part(3)).alias("value")).where(F.col("qid") != "")


def wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """Pages of namespace 0 of an XML dump, plain or bz2: (page_id, title, redirect, text, revision_id, timestamp)."""
    schema = "title string, ns int, id long, redirect struct<_title:string>, revision struct<id:long,timestamp:string,text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", False).schema(schema).load(path)
    return pages.where("ns = 0").select(
        F.col("id").alias("page_id"), "title", F.col("redirect._title").alias("redirect"), F.coalesce("revision.text._VALUE", F.lit("")).alias("text"),
        F.col("revision.id").alias("revision_id"), F.col("revision.timestamp").alias("timestamp"),
    )


def instances(spark: SparkSession, path: str, schema: str = "name string, desc string, aliases array<string>") -> DataFrame:
    """The instances (name, desc, aliases, …) of documents {"instances": […]}, one or more files: those without a name go, the last of a name stays; descriptions and aliases stripped, blank aliases out."""
    files = spark.read.schema(f"instances array<struct<{', '.join(c.strip().replace(' ', ':', 1) for c in schema.split(', '))}>>").option("multiLine", True).json(path)
    at = F.struct(F.input_file_name().alias("file"), "pos").alias("at")
    rows = files.select(F.posexplode("instances").alias("pos", "i")).where(F.col("i.name") != "").select("i", at)
    last = rows.groupBy(F.col("i.name").alias("name")).agg(F.max_by("i", "at").alias("i")).select("i.*")
    stripped = F.filter(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.trim(a)), lambda a: a != "")
    return last.withColumns({"desc": F.trim(F.coalesce("desc", F.lit(""))), "aliases": stripped})


#: Images asked of a concept by the strictness of its gate, in batches of version 2.
GATES = {"strict": 40, "normal": 20, "loose": 10}


def concept_batch(spark: SparkSession, path: str) -> DataFrame:
    """Concepts (name, aliases, carriers, taxonomy, min_images) of a batch, version 2 or 3; the first of a name stays.

    A concept's own quota goes before that of its gate, then the batch's default, then 20. Other versions fail.
    """
    one = "name:string,aliases:array<string>,carriers:string,taxonomy:array<string>,min_images:int,gate:string"
    schema = f"version string, default_min_images int, concepts array<struct<{one}>>"
    batch = spark.read.schema(schema).option("multiLine", True).json(path)
    major = F.substring_index(F.coalesce("version", F.lit("2")), ".", 1)
    checked = F.when(major.isin("2", "3"), major).otherwise(F.raise_error(F.concat(F.lit("unsupported batch version "), F.col("version"))).cast("string"))
    rows = batch.select(checked.alias("major"), "default_min_images", F.posexplode("concepts").alias("pos", "c"))
    gate = F.create_map(*[F.lit(x) for kv in GATES.items() for x in kv])[F.col("c.gate")]
    quota = F.coalesce("c.min_images", F.when(F.col("major") == "2", gate), "default_min_images", F.lit(20))
    rows = rows.select(
        F.trim("c.name").alias("name"), F.coalesce("c.aliases", F.array().cast("array<string>")).alias("aliases"), F.coalesce("c.carriers", F.lit("image+text")).alias("carriers"),
        F.coalesce("c.taxonomy", F.array().cast("array<string>")).alias("taxonomy"), quota.alias("min_images"), "pos",
    ).where("name != ''")
    return first_wins(rows, ["name"], ["pos"]).drop("pos")


def concept_seeds(concepts: DataFrame) -> DataFrame:
    """(name, query, lang, top_n_hint, taxonomy): a seed for the name and for each alias that differs from it."""
    queries = F.concat(F.array("name"), F.filter(F.transform("aliases", lambda a: F.trim(a)), lambda a: (a != "") & (a != F.col("name"))))
    seeds = concepts.select("name", F.explode(queries).alias("query"), "min_images", "taxonomy")
    return seeds.select("name", "query", text.lang_tag(F.col("query")).alias("lang"), text.quota_hint(F.col("min_images")).alias("top_n_hint"), "taxonomy")


#: A quoted text (quotes in it escaped or doubled) or a bare word. No quantifier gives anything back, so a field costs one pass and no stack, however long it is.
SQL_FIELD = r"'(?:[^'\\]++|\\.|'')*+'|[^,()']++"
#: Tuples one after the other from the start of a line or of the VALUES of its INSERT statement; a malformed one ends the line.
SQL_TUPLE = rf"(?s)(?:\G(?:INSERT INTO [^'()]*(?:\([^')]*\)\s*)?VALUES)?\s*,?\s*)\(((?:{SQL_FIELD})(?:,(?:{SQL_FIELD}))*+)\)"
#: What an escaped character stands for; any other keeps its backslash.
SQL_ESCAPES = {"n": "\n", "r": "\r", "0": "\0", "Z": "\x1a", "'": "'", '"': '"', "\\": "\\"}


def sql_text(field: Column) -> Column:
    """The text that a quoted field stands for; null for a bare word."""
    codes = F.create_map(*[F.lit(x) for k, v in SQL_ESCAPES.items() for x in (f"\\{k}", v)], F.lit("''"), F.lit("'"))
    bits = F.regexp_extract_all(F.substring(field, 2, F.length(field) - 2), F.lit(r"(?s)(\\.|''|[^\\']++)"), F.lit(1))
    return F.when(field.startswith("'"), F.array_join(F.transform(bits, lambda b: F.coalesce(codes[b], b)), ""))


def sql_dump_rows(spark: SparkSession, path: str) -> DataFrame:
    """(fields) of the tuples in the INSERT statements of a dump, as they are written; a statement may go on over lines that begin with a tuple. Lines that hold anything else are passed over."""
    lines = spark.read.text(path).where(F.col("value").rlike("^(?:INSERT INTO|\\()"))
    rows = lines.select(F.explode(F.regexp_extract_all("value", F.lit(SQL_TUPLE), F.lit(1))).alias("t"))
    return rows.select(F.regexp_extract_all("t", F.lit(f"(?s)({SQL_FIELD})"), F.lit(1)).alias("fields"))


def sql_dump_tuples(spark: SparkSession, path: str, least: int = 51_200, most: int = 64 << 20) -> DataFrame:
    """(fname, size) of the bitmaps of an image table's dump: the name, its size, width, height, the metadata (quoted, of any length), bits, the media type. Rows of another shape are passed over."""
    f = lambda i: F.get("fields", F.lit(i))
    rows = sql_dump_rows(spark, path).where((f(6) == "'BITMAP'") & f(4).startswith("'") & f(0).startswith("'") & f(1).rlike("^[0-9]+$"))
    return rows.select(sql_text(f(0)).alias("fname"), f(1).try_cast("long").alias("size")).where(F.col("size").between(least, most))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(rel, size) of the objects under a folder, by one listing; `rel` is the path below the folder, contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    root = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/*(?=/)", "", path).strip("/")
    return files.select(F.regexp_replace("path", f"^.*?\\Q/{root}/\\E", "").alias("rel"), F.col("length").alias("size"))


def alias_cache(spark: SparkSession, path: str) -> DataFrame:
    """(name, alias) of a cache that is one JSON object of names; alias null for those judged and rejected. A missing or broken file is an empty cache."""
    try:
        text_ = spark.read.text(path, wholetext=True)
        rows = text_.select(F.explode(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"})).alias("name", "alias"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "name string, alias string")
    return rows


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of each file with their 0-based numbers, blank ones too.

    A file is read in as many ranges as Spark makes of it (a gzip in one). The lines of each range are counted
    and the counts summed up, one number a range; within a range lines come in order. Should the second reading be cut into
    other ranges than the first, it fails rather than number wrongly.
    """
    span = F.struct("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length")
    lines = lambda: spark.read.text(path).select(span.alias("span"), "value", F.monotonically_increasing_id().alias("at"))
    ranges = lines().groupBy("span").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("span.file_path").orderBy("span.file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(F.col("span").alias("of"), "first", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    known = lines().join(F.broadcast(offsets), F.col("span") == F.col("of"), "left")  # a row a range
    checked = F.when(F.col("of").isNull() | ~(F.col("at") - F.col("first")).between(0, F.col("n") - 1), F.raise_error(F.lit("the files were cut into other ranges meanwhile")).cast("long"))
    return known.select(F.col("span.file_path").alias("file"), F.coalesce(checked, F.col("at") - F.col("first") + F.col("before")).alias("line"), "value")


def fetch_list(spark: SparkSession, path: str, shard: int = 0, shards: int = 1, one: bool = False) -> DataFrame:
    """(fname, mid, pairs, size) of a shard of a fetch list: tab-separated lines of three columns or more; every `shards`-th of these by their place in their file, from `shard` on. Size is 0 where the fourth is no number.

    With `one` the files, in the order of their names, are one list. Valid lines are numbered as they are read within the range of a file
    that holds them, without a sort, and the counts of the ranges before are added. Should the second reading be cut into other ranges, it fails.
    """
    cut = F.struct("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_block_length")
    valid = lambda: spark.read.text(path).select(cut.alias("span"), F.split("value", "\t").alias("p")).where(F.size("p") >= 3).select("span", "p", F.monotonically_increasing_id().alias("at"))
    files = Window.orderBy("of.file_path", "of.file_block_start") if one else Window.partitionBy("of.file_path").orderBy("of.file_block_start")
    ranges = valid().groupBy(F.col("span").alias("of")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    counts = ranges.withColumn("before", F.coalesce(F.sum("n").over(files.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    known = valid().join(F.broadcast(counts), F.col("span") == F.col("of"), "left")  # a row a range
    checked = F.when(F.col("of").isNull() | ~(F.col("at") - F.col("first")).between(0, F.col("n") - 1), F.raise_error(F.lit("the files were cut into other ranges meanwhile")).cast("long"))
    mine = known.where(F.coalesce(checked, F.col("at") - F.col("first") + F.col("before")) % shards == shard)
    size = F.when(F.get("p", F.lit(3)).rlike("^[0-9]+$"), F.get("p", F.lit(3)).try_cast("long"))
    return mine.select(F.col("p")[0].alias("fname"), F.col("p")[1].alias("mid"), F.col("p")[2].alias("pairs"), F.coalesce(size, F.lit(0)).alias("size"))


def telemetry(spark: SparkSession, path: str, machine: str = "([^/]+?)(?:\\.[^./]*)?$") -> DataFrame:
    """(machine, engine, attempts, results, error_rate): the snapshots, a JSON file each, of a folder; `machine` finds the machine's name in the file's. Broken files give no row."""
    shape = "engines map<string,struct<attempts:long,results:long,error_rate:double>>"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    whole = files.select(F.regexp_extract("path", machine, 1).alias("machine"), F.from_json(F.decode("content", "UTF-8"), shape).alias("t"))
    rows = whole.select("machine", F.explode("t.engines").alias("engine", "e"))
    return rows.select("machine", "engine", *[F.coalesce(f"e.{c}", F.lit(0)).alias(c) for c in ("attempts", "results", "error_rate")])
