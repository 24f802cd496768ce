"""Sources and sinks: tables written as the files that the readers know, read again; ledgers, replacements, telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import alerts, tasks
from cairn.sources import readers, sinks

from .catalogue import folder, query, table


def _lines(df: DataFrame, value, name: str, **options: str) -> str:
    """A folder of text files with one line for each row."""
    path = folder(df.sparkSession, name)
    df.select(value.alias("value")).write.options(**options).text(path)
    return path


@query("SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE doc_id % 10 <> 3")
def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of gzipped JSON lines; one line of ten is torn, blank lines stand between."""
    whole = F.to_json(F.struct("doc_id", "source", "text"))
    line = F.when(F.col("doc_id") % 10 == 3, F.substring(whole, 1, 20)).otherwise(F.concat(whole, F.when(F.col("doc_id") % 7 == 0, "\n  ").otherwise("")))
    path = _lines(table(spark, sf_dir, "documents"), line, "ledger", compression="gzip")
    rows = readers.manifest(spark, path, "doc_id long, source string, text string")
    return rows.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("SELECT o_orderkey, o_orderpriority AS a, '\"' || o_clerk AS b FROM (SELECT *, 'c' || o_custkey AS o_clerk FROM orders)")
def tab_separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated rows with a quote mark that opens nothing, gzipped."""
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderpriority", F.concat(F.lit('"c'), F.col("o_custkey").cast("string")))
    path = _lines(table(spark, sf_dir, "orders"), line, "tsv", compression="gzip")
    return readers.tsv(spark, path, "o_orderkey long, a string, b string")


@query("SELECT 'Q' || o_orderkey AS qid, CASE WHEN o_orderkey % 2 = 0 THEN 'P18' ELSE 'P373' END AS prop, CASE WHEN o_orderkey % 2 = 0 THEN 'http://c/Special:FilePath/' || o_orderkey || '.jpg' ELSE 'a \"' || o_orderpriority || '\"' END AS value FROM orders WHERE o_orderkey % 3 <> 0")
def triple_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of two properties out of three."""
    n = F.col("o_orderkey")
    prop = F.when(n % 3 == 0, "P99").when(n % 2 == 0, "P18").otherwise("P373")
    value = F.when(n % 2 == 0, F.concat(F.lit("<http://c/Special:FilePath/"), n, F.lit(".jpg>"))).otherwise(F.concat(F.lit('"a \\"'), "o_orderpriority", F.lit('\\""@en')))
    line = F.concat(F.lit("<http://w/entity/Q"), n, F.lit("> <http://w/prop/direct/"), prop, F.lit("> "), value, F.lit(" ."))
    return readers.triples(spark, _lines(table(spark, sf_dir, "orders"), line, "triples"), ["P18", "P373"])


@query("""
    SELECT doc_id AS page_id, 'T' || doc_id AS title, CASE WHEN doc_id % 4 = 0 THEN 'T0' END AS redirect, CASE WHEN doc_id % 5 = 0 THEN md5('') ELSE md5(text) END AS text_md5, doc_id + 7 AS revision_id FROM documents WHERE doc_id % 3 <> 0""")
def dump_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of an XML dump; every third is of another namespace, every fourth redirects, every fifth has no text."""
    d = F.col("doc_id")
    escaped = F.col("text")
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), ("\r", "&#13;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(coded))
    body = F.when(d % 5 == 0, "").otherwise(F.concat(F.lit('<text xml:space="preserve">'), escaped, F.lit("</text>")))
    page = F.concat(
        F.lit("<page><title>T"), d, F.lit("</title><ns>"), F.when(d % 3 == 0, "1").otherwise("0"), F.lit("</ns><id>"), d, F.lit("</id>"), F.when(d % 4 == 0, '<redirect title="T0" />').otherwise(""),
        F.lit("<revision><id>"), d + 7, F.lit("</id>"), body, F.lit("</revision></page>"),
    )
    parts = table(spark, sf_dir, "documents").groupBy(F.floor(d / 500).alias("part")).agg(F.concat(F.lit("<mediawiki>"), F.array_join(F.collect_list(page), "\n"), F.lit("</mediawiki>")).alias("value"))
    path = folder(spark, "dump")
    parts.write.partitionBy("part").option("compression", "bzip2").text(path)  # a file for 500 pages
    pages = readers.wiki_dump(spark, path)
    return pages.select("page_id", "title", "redirect", F.md5(F.col("text").cast("binary")).alias("text_md5"), "revision_id")


@query("""
    WITH c AS (SELECT p_brand AS name, CASE WHEN right(p_brand, 1) = '1' THEN 40 WHEN right(p_brand, 1) = '2' THEN 10 ELSE 25 END AS least FROM (SELECT DISTINCT p_brand FROM part))
    SELECT name, name AS query, 'latin' AS lang, greatest(1, ceil(least * 1.6 / 56))::INT AS top_n_hint FROM c UNION ALL SELECT name, name || ' 墙', 'zh', greatest(1, ceil(least * 1.6 / 56))::INT FROM c""")
def concept_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds of a batch of concepts, the brands: quotas by gate, own or the batch's; aliases that repeat the name give none."""
    brand, last = F.col("p_brand"), F.right("p_brand", F.lit(1))
    one = F.struct(brand.alias("name"), F.array(brand, F.concat(brand, F.lit(" 墙"))).alias("aliases"), F.when(last == "1", "strict").alias("gate"), F.when(last == "2", 10).alias("min_images"))
    batch = table(spark, sf_dir, "part").groupBy(F.lit("2.1").alias("version"), F.lit(25).alias("default_min_images")).agg(F.collect_set(one).alias("concepts"))  # a batch is one file
    path = folder(spark, "batch")
    batch.write.json(path)
    return readers.concept_seeds(readers.concept_batch(spark, path)).select("name", "query", "lang", "top_n_hint")


@query("""
    SELECT s_name AS name, 'N ' || s_nationkey AS desc, CASE WHEN s_suppkey % 3 = 0 THEN [] ELSE ['a' || s_suppkey] END AS aliases FROM supplier WHERE s_suppkey % 5 <> 4""")
def named_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances of documents with five hundred suppliers each: some without a name, each told twice, the second time with a description and aliases, blank ones among them."""
    n = F.col("s_suppkey")
    aliases = F.when(n % 3 != 0, F.array(F.lit(" "), F.concat(F.lit(" a"), n.cast("string")))).otherwise(F.array(F.lit("")))
    name = F.when(n % 5 == 4, F.when(n % 2 == 0, "")).otherwise(F.col("s_name"))
    once = lambda turn, desc, al: F.struct(n.alias("n"), F.lit(turn).alias("turn"), name.alias("name"), desc.alias("desc"), al.alias("aliases"))
    none = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    twice = F.array(once(0, *none), once(1, F.concat(F.lit(" N "), F.col("s_nationkey").cast("string"), F.lit(" ")), aliases))
    batches = table(spark, sf_dir, "supplier").select(F.floor(n / 500).alias("part"), F.explode(twice).alias("i")).groupBy("part").agg(F.array_sort(F.collect_list("i")).alias("instances"))  # a thousand
    path = folder(spark, "instances")
    batches.withColumn("instances", F.transform("instances", lambda i: i.dropFields("n", "turn"))).write.partitionBy("part").json(path)
    return readers.instances(spark, path)


@query(r"""
    SELECT 'f''' || o_orderkey || '(1)' || chr(10) || '\.jpg' AS fname, 51200 + o_orderkey AS size FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0
    UNION ALL SELECT 'BITMAP' || doc_id || '.jpg', 60000 + doc_id FROM documents WHERE doc_id % 3 = 0""")
def dump_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of INSERT statements, three to a statement, and whole texts of documents as metadata, some repeated to over 100,000 characters, on lines of their own: drawings and small files go; a file named BITMAP is none by that."""
    n, d = F.col("o_orderkey"), F.col("doc_id")
    one = lambda name, size, metadata, media: F.concat(F.lit("('"), name, F.lit("',"), size.cast("string"), F.lit(",640,480,'"), metadata, F.lit("',8,"), media, F.lit(",'image','jpeg','x')"))
    media = lambda yes: F.when(yes, "'BITMAP'").otherwise("'DRAWING'")
    first = one(F.concat(F.lit("f\\'"), n, F.lit("(1)\\n\\\\.jpg")), F.when(n % 3 == 0, F.lit(10)).otherwise(n + 51200), F.lit("{\"a\\\"b'')\": (1,2)}"), media(n % 2 == 0))
    line = F.concat(F.lit("INSERT INTO `image` VALUES "), first, F.lit(",('small',5,1,1,'',8,'BITMAP'),('BITMAP',70000,1,1,'0',8,NULL);"))
    quoted = F.col("text")
    for plain, coded in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        quoted = F.replace(quoted, F.lit(plain), F.lit(coded))
    times = F.ceil(F.lit(100_000) / F.greatest(F.lit(1), F.length("text"))).cast("int")
    long = F.when(d % 100 == 0, F.repeat(F.concat(quoted, F.lit("\\\\''),(''")), times)).otherwise(quoted)
    more = one(F.concat(F.lit("BITMAP"), d, F.lit(".jpg")), d + 60000, long, media(d % 3 == 0))
    path = _lines(table(spark, sf_dir, "orders"), line, "tuples")
    table(spark, sf_dir, "documents").select(F.concat(more, F.lit(",")).alias("value")).write.mode("append").text(path)
    return readers.sql_dump_tuples(spark, path)


@query("SELECT lang || '/' || source AS rel, 1 AS files, sum(strlen(text))::BIGINT AS size FROM documents GROUP BY 1")
def inventory_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files under a folder of folders, by their path in it; those of one name in two folders stay apart."""
    path = folder(spark, "lake")
    parts = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.array_join(F.collect_list("text"), "").alias("value"))
    parts.repartition("lang", "source").write.partitionBy("lang", "source").option("lineSep", "\x01").text(path)
    found = readers.inventory(spark, path).where("rel LIKE '%part-%'")
    shown = F.concat_ws("/", F.regexp_extract("rel", "lang=([^/]*)/", 1), F.regexp_extract("rel", "source=([^/]*)/", 1))
    return found.groupBy(shown.alias("rel")).agg(F.count("*").cast("int").alias("files"), F.sum(F.col("size") - 1).alias("size"))


@query("SELECT p_brand AS name, CASE WHEN right(p_brand, 1) <> '1' THEN lower(p_brand) END AS alias FROM (SELECT DISTINCT p_brand FROM part)")
def alias_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of aliases; a second, broken file counts as empty."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    entry = F.struct("p_brand", F.when(F.right("p_brand", F.lit(1)) != "1", F.lower("p_brand")).alias("alias"))
    path = _lines(brands.groupBy().agg(F.map_from_entries(F.collect_list(entry)).alias("m")), F.to_json("m", {"ignoreNullFields": "false"}), "aliases")
    broken = _lines(spark.range(1), F.lit('{"a": '), "broken")
    return readers.alias_cache(spark, path).unionByName(readers.alias_cache(spark, broken)).unionByName(readers.alias_cache(spark, f"{broken}-missing"))


@query("""
    WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line FROM documents) SELECT doc_id FROM n WHERE line % 4 = 1 AND doc_id % 10 <> 3 AND doc_id % 3 <> 0 ORDER BY line LIMIT 50""")
def candidate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard of four of a file's lines by their number; torn lines count for it. Fifty are asked for (the feature)."""
    whole = F.to_json(F.struct("doc_id", F.when(F.col("doc_id") % 3 == 0, "x").otherwise("y").alias("src")))
    line = F.when(F.col("doc_id") % 10 == 3, F.substring(whole, 1, 5)).otherwise(whole)
    path = folder(spark, "candidates")
    table(spark, sf_dir, "documents").select("doc_id", line.alias("value")).coalesce(1).sortWithinPartitions("doc_id").select("value").write.text(path)
    lines = readers.numbered_lines(spark, path).withColumn("r", F.from_json("value", "doc_id long, src string"))
    return tasks.candidate_lines(lines, "line", 1, 4, F.col("r.src") == "y", 50).select("r.doc_id")


@query("""
    SELECT event_type AS engine, user_id % 5 AS machine, count(*) AS attempts, count(*) FILTER (WHERE value < 10) / count(*)::DOUBLE AS error_rate, count(*) >= 10 AND count(*) FILTER (WHERE value < 10) / count(*)::DOUBLE > 0.3 AS alert FROM events GROUP BY 1, 2""")
def engine_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engines whose errors set off an alert, from the snapshot that each machine wrote."""
    failed = F.count_if(F.col("value") < 10)
    rows = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 5).alias("machine"), "event_type").agg(F.count("*").alias("attempts"), (F.count("*") - failed).alias("results"), (failed / F.count("*")).alias("error_rate"))
    engines = F.map_from_entries(F.collect_list(F.struct("event_type", F.struct("attempts", "results", "error_rate"))))
    path = folder(spark, "telemetry")
    rows.groupBy("machine").agg(engines.alias("engines")).select("machine", F.to_json(F.struct("engines")).alias("value")).write.partitionBy("machine").text(path)
    seen = readers.telemetry(spark, path, "machine=([^/]+)/")
    return seen.select("engine", F.col("machine").cast("long").alias("machine"), "attempts", "error_rate", alerts.failing(F.col("error_rate"), F.col("attempts")).alias("alert"))


@query("SELECT 'done' AS ledger, doc_id, NULL AS reason FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT 'dead', doc_id, 'net:timeout' FROM documents WHERE doc_id % 4 = 1 UNION ALL SELECT 'dead', doc_id, 'capped' FROM documents WHERE doc_id % 4 = 2")
def outcome_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two ledgers that a pass leaves which ran twice."""
    d = F.col("doc_id") % 4
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(d == 0, "done").when(d == 1, "net:timeout").when(d == 2, "capped").otherwise("skip").alias("outcome"))
    done, dead = folder(spark, "done"), folder(spark, "dead")
    for _ in range(2):
        sinks.append_outcomes(rows, "outcome", done, dead, ["doc_id"], ["doc_id"])
    first = spark.read.parquet(done).select(F.lit("done").alias("ledger"), "doc_id", F.lit(None).cast("string").alias("reason"))
    return first.unionByName(spark.read.parquet(dead).select(F.lit("dead").alias("ledger"), "doc_id", "reason"))


@query("SELECT doc_id, n_chars * 4 AS n_chars FROM documents WHERE doc_id % 2 = 0")
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice by one derived from itself."""
    path = folder(spark, "table")
    table(spark, sf_dir, "documents").select("doc_id", "n_chars").write.parquet(path)
    for keep in ("doc_id % 2 = 0", "true"):
        sinks.replace_table(spark.read.parquet(path).where(keep).withColumn("n_chars", F.col("n_chars") * 2), path)
    return spark.read.parquet(path)


@query("SELECT doc_id, lang, source, 'm:' || lang AS mirror FROM documents WHERE lang <> '' QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) = 1")
def keyed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger keyed by two columns that takes three mirrors in turn, the last of them twice."""
    path = folder(spark, "keyed")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.concat(F.lit("m:"), "lang").alias("mirror"))
    for part in (docs.where("lang = 'en'"), docs.where("lang IN ('fr', 'en')"), docs, docs):
        sinks.append_manifest(part, path, ["lang", "source"], ["doc_id"], required=("mirror",))
    return spark.read.parquet(path)


@query("SELECT doc_id, source || ' ' || lang AS author FROM documents")
def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors without the tags around them."""
    tagged = F.concat(F.lit(' <a href="x">'), "source", F.lit(" <i>"), "lang", F.lit("</i></a> "))
    return table(spark, sf_dir, "documents").select("doc_id", text.drop_tags(tagged).alias("author"))


@query("""
    WITH v AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT 'f' || o_orderkey AS fname, 'M' || o_custkey AS mid, 'Q1:r' AS pairs, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE 0 END AS size FROM v WHERE r % 4 = 1""")
def fetch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard of four of a fetch list, by place among its valid lines; every fifth line is short, two of three have no size."""
    n = F.col("o_orderkey")
    size = F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, "big")
    whole = F.concat_ws("\t", F.concat(F.lit("f"), n), F.concat(F.lit("M"), F.col("o_custkey")), F.lit("Q1:r"), size)
    path = folder(spark, "fetch")
    lines = table(spark, sf_dir, "orders").select(n, F.when(n % 5 == 0, F.concat(F.lit("short\t"), n)).otherwise(whole).alias("value"))
    lines.orderBy("o_orderkey").select("value").write.text(path)  # files by ranges of the key, together one list
    return readers.fetch_list(spark, path, 1, 4, one=True)


@query("""
    SELECT 'T' || doc_id AS title, md5(text) AS text_md5, array_to_string(list_transform(range(0, least(6, doc_id % 8 + 1)::INT), lambda i: 'F' || i || '.jpg'), ',') AS files FROM documents WHERE doc_id % 8 < 6
    UNION ALL SELECT 'T' || doc_id, md5(left(text, (length(text) // 8)::INT * 6)), 'F0.jpg,F1.jpg,F2.jpg,F3.jpg,F4.jpg,F5.jpg' FROM documents WHERE doc_id % 8 >= 6""")
def continued_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages put together from rounds: whole texts in up to six parts, and the first six of eight parts."""
    rounds = (F.col("doc_id") % 8 + 1).cast("int")
    n = F.when(rounds > 6, 8).otherwise(rounds)
    step = F.floor(F.length("text") / n).cast("int")
    last = F.col("round") == n - 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("round"))
    part = F.when(last, F.substr(F.col("text"), F.col("round") * step + 1)).otherwise(F.substr(F.col("text"), F.col("round") * step + 1, step))
    told = docs.select(F.floor(F.col("doc_id") / 50).alias("batch"), "round", F.concat(F.lit("T"), "doc_id").alias("title"), F.array(F.concat(F.lit("F"), "round", F.lit(".jpg"))).alias("files"), part.alias("text"))
    return tasks.merged_rounds(told).select("title", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.array_join("files", ",").alias("files"))
