"""Audits: reconciliation, self-consistency, sniffing, publishing, needed blobs and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import gates
from cairn.operators.relational import decile, first_wins, global_rank, reconcile

from .catalogue import query, table


@query("""
    WITH a AS (SELECT doc_id AS rel, n_chars AS size FROM documents WHERE doc_id % 10 <> 0), b AS (SELECT doc_id AS rel, CASE WHEN doc_id % 13 = 0 THEN n_chars + 1 ELSE n_chars END AS size FROM documents WHERE doc_id % 11 <> 0)
    SELECT coalesce(a.rel, b.rel) AS rel, CASE WHEN b.rel IS NULL THEN 'missing' WHEN a.rel IS NULL THEN 'orphan' WHEN a.size <> b.size THEN 'size_mismatch' WHEN b.size < 500 THEN 'small' WHEN b.size > 8000 THEN 'large' ELSE 'ok' END AS status
    FROM a FULL JOIN b ON a.rel = b.rel""")
def reconcile_5way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger and an inventory, both made from the documents, that disagree in known places."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("rel"), F.col("n_chars").alias("size"))
    found = docs.where("rel % 11 <> 0").withColumn("size", F.when(F.col("rel") % 13 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return reconcile(docs.where("rel % 10 <> 0"), found, "rel", "size", 500, 8000)


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars, count(DISTINCT md5(text)) AS distinct_texts, count(DISTINCT (source, lang)) AS pairs FROM documents GROUP BY lang")
def audit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.countDistinct(F.md5(F.col("text").cast("binary"))).alias("distinct_texts"), F.countDistinct("source", "lang").alias("pairs")
    )


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'bad' ELSE 'ok' END AS status FROM pages")
def self_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose claimed digest is or isn't that of their address."""
    url = F.col("url")
    claimed = F.when(F.col("page_id") % 3 == 0, F.sha2(F.concat(url, F.lit("x")), 256)).otherwise(F.sha2(url, 256))
    return table(spark, sf_dir, "pages").select("page_id", F.when(gates.self_consistent(claimed, url), "ok").otherwise("bad").alias("status"))


#: Bodies of every class, by page: signatures, markup with and without a code or title, and bytes of no class.
BODIES = {
    0: ("FFD8FFE0", "jpeg"), 2: ("", "empty"), 3: ("000102030405060708", "hex:0001020304050607"), 4: ("41542654464F524D00", "djvu"), 5: ("524946460000000057454250", "webp"), 6: ("424D0001", "hex:424d0001"),
}
MARKUP = {7: ("  <!DOCTYPE html><p>Error: 429", "html(429)"), 8: ("<html><p>x", "html(?)"), 9: ("<p>hi", "html()"), 10: ("\n<svg>", "svg"), 11: ("<?xml version=1?><svg>", "xml")}


#: The first 2048 bytes of a page in hexadecimal, and what stands in them: an error's code, and a title of up to 80 bytes.
_CODE = "unhex(regexp_extract(head, '^(?:..)*?4572726F723A(?:0[9A-D]|20)*((?:3[0-9]){3})', 1))::VARCHAR"
_TITLED = "^(?:..)*?3C7469746C653E((?:[0-24-9A-F].|3[0-9ABD-F]){0,80})3C2F7469746C653E"


@query(
    "SELECT page_id, CASE page_id % 12 "
    + " ".join(f"WHEN {k} THEN '{c}'" for k, (_, c) in (BODIES | MARKUP).items())
    + f" ELSE 'html(' || CASE WHEN {_CODE} <> '' THEN {_CODE} WHEN regexp_matches(head, '{_TITLED}') THEN left(trim(decode(unhex(regexp_extract(head, '{_TITLED}', 1)))), 40) ELSE '?' END || ')' END AS class"
    + " FROM (SELECT page_id, left(hex(encode(html)), 4096) AS head FROM pages)"
)
def magic_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of bodies made for each page; every twelfth is the page itself."""
    kind, body = F.col("page_id") % 12, F.col("html").cast("binary")
    for k, (digits, _) in BODIES.items():
        body = F.when(kind == k, F.unhex(F.lit(digits))).otherwise(body)
    for k, (markup, _) in MARKUP.items():
        body = F.when(kind == k, F.lit(markup).cast("binary")).otherwise(body)
    return table(spark, sf_dir, "pages").select("page_id", text.magic_class(body).alias("class"))


@query("SELECT page_id, CASE WHEN page_id % 10 = 1 THEN 'fail' WHEN page_id % 10 = 2 THEN 'bad' WHEN page_id % 10 = 3 THEN 'dup' WHEN page_id % 10 = 4 THEN 'empty' WHEN page_id % 10 = 5 THEN 'bad' ELSE 'ok' END AS outcome FROM pages")
def publish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("page_id") % 10
    body = F.when(d == 4, "").otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", gates.publish_outcome(d == 1, d != 2, d == 3, body, d != 5).alias("outcome"))


@query("SELECT sha, min(doc_id) AS doc_id FROM (SELECT doc_id, sha256(text) AS sha FROM documents) WHERE sha NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'fr') AND sha NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY sha")
def needed_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("sha"))
    deleted = docs.join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_semi").select("sha")
    needed = docs.join(docs.where("lang = 'fr'").select("sha"), "sha", "left_anti").join(deleted, "sha", "left_anti")
    return first_wins(needed.select("sha", "doc_id"), ["sha"], ["doc_id"])


@query("SELECT sha, page_id, grp FROM (SELECT sha256(regexp_replace(url, '\\?.*$', '')) AS sha, page_id, page_id % 4 AS grp FROM pages) QUALIFY row_number() OVER (PARTITION BY sha ORDER BY grp, page_id) = 1")
def page_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which group's row claims each page: the first group, then the first row."""
    rows = table(spark, sf_dir, "pages").select(F.sha2(F.regexp_replace("url", "\\?.*$", ""), 256).alias("sha"), "page_id", (F.col("page_id") % 4).alias("grp"))
    return first_wins(rows, ["sha"], ["grp", "page_id"])


@query("SELECT l.source, l.cls, count(*) AS n FROM (SELECT d.doc_id, d.source, CASE WHEN b.toxic = 1 THEN 'html' ELSE 'jpeg' END AS cls FROM documents d JOIN labels b USING (doc_id)) l GROUP BY 1, 2")
def sniff_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sniff = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "html").otherwise("jpeg").alias("cls"))
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(sniff, "doc_id").groupBy("source", "cls").agg(F.count("*").alias("n"))


_LEDGER = """
    l AS (SELECT doc_id, n_chars, lang AS ext, doc_id % 3 AS tier, strftime(TIMESTAMP '2024-01-01' + to_days((doc_id % 9)::INT), '%m-%d') AS day, least(9, (row_number() OVER (ORDER BY doc_id) - 1) * 10 // count(*) OVER ())::INT AS decile FROM documents),
    s AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'html' WHEN 1 THEN 'html' WHEN 2 THEN 'empty' WHEN 3 THEN 'err' ELSE 'jpeg' END AS class, CASE doc_id % 14 WHEN 0 THEN '429' WHEN 1 THEN '404' END AS err FROM documents WHERE n_chars < 2000)"""


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as a ledger with day, tier and decile of its order, and what was sniffed of the small ones."""
    d, docs = F.col("doc_id"), table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.col("lang").alias("ext"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (d % 9).cast("int")), "MM-dd")
    ranked = global_rank(docs, "doc_id", [], "r").withColumn("decile", decile(F.col("r"), docs.count())).drop("r")
    kind = F.when(d % 7 < 2, "html").when(d % 7 == 2, "empty").when(d % 7 == 3, "err").otherwise("jpeg")
    sniffed = docs.where("n_chars < 2000").select("doc_id", kind.alias("class"), F.when(d % 14 == 0, "429").when(d % 14 == 1, "404").alias("err"))
    return ranked.withColumns({"tier": d % 3, "day": day}), sniffed


@query(f"WITH {_LEDGER} SELECT l.*, s.class, s.err FROM l JOIN s USING (doc_id) WHERE s.class IN ('html', 'empty', 'missing', 'err')")
def poison_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a ledger whose bodies are error pages, empty or unreadable."""
    return gates.poisoned(*_ledger(spark, sf_dir), "doc_id")


@query(f"""
    WITH {_LEDGER}, p AS (SELECT l.*, s.class, s.err FROM l JOIN s USING (doc_id) WHERE s.class IN ('html', 'empty', 'missing', 'err')), h AS (SELECT * FROM p WHERE class = 'html'),
    k AS (SELECT 'err' AS figure, err AS key, count(*)::VARCHAR AS value FROM h WHERE err IS NOT NULL GROUP BY err UNION ALL SELECT 'tier', tier::VARCHAR, count(*)::VARCHAR FROM h GROUP BY tier
        UNION ALL SELECT 'ext', ext, count(*)::VARCHAR FROM h GROUP BY ext UNION ALL SELECT 'decile', decile::VARCHAR, count(*)::VARCHAR FROM h GROUP BY decile
        UNION ALL SELECT 'day', day, (SELECT count(*) FROM h WHERE h.day = l.day) || '/' || count(*) FROM l GROUP BY day
        UNION ALL SELECT 'rows', 'ledger', count(*)::VARCHAR FROM l UNION ALL SELECT 'rows', 'poison', count(*)::VARCHAR FROM p UNION ALL SELECT 'rows', 'html', count(*)::VARCHAR FROM h UNION ALL SELECT 'rows', 'html_bytes', coalesce(sum(n_chars), 0)::BIGINT::VARCHAR FROM h)
    SELECT '{{' || string_agg('"' || figure || '":{{' || inner_ || '}}', ',' ORDER BY figure) || '}}' AS stats FROM (SELECT figure, string_agg('"' || key || '":"' || value || '"', ',' ORDER BY key) AS inner_ FROM k GROUP BY figure)""")
def audit_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit as one row of JSON: poison by error code, tier, extension, decile of the ledger, and of each day's rows."""
    ledger, sniffed = _ledger(spark, sf_dir)
    return audit_report(ledger, gates.poisoned(ledger, sniffed, "doc_id"), "n_chars", {"err": "err", "tier": "tier", "ext": "ext", "decile": "decile"}, "day")


def audit_report(ledger: DataFrame, poison: DataFrame, size: str, figures: dict[str, str], day: str) -> DataFrame:
    """(stats): one JSON object of objects: for each figure the error pages by a column, for each day the share `x/y` of its rows, and the rows of ledger, poison and error pages.

    The counts by column have few keys each; only they are put together in one row.
    """
    html = poison.where(F.col("class") == "html")
    one = lambda df, figure, key, value: df.select(F.lit(figure).alias("figure"), F.col(key).cast("string").alias("key"), value.cast("string").alias("value"))
    parts = [one(html.where(F.col(c).isNotNull()).groupBy(c).count(), name, c, F.col("count")) for name, c in figures.items()]
    days = ledger.groupBy(day).agg(F.count("*").alias("y")).join(html.groupBy(day).agg(F.count("*").alias("x")), day, "left")
    parts.append(one(days, "day", day, F.concat_ws("/", F.coalesce("x", F.lit(0)).cast("string"), F.col("y").cast("string"))))
    for name, df, value in (("ledger", ledger, F.count("*")), ("poison", poison, F.count("*")), ("html", html, F.count("*")), ("html_bytes", html, F.coalesce(F.sum(size), F.lit(0)))):
        parts.append(one(df.agg(value.alias("v")).withColumn("k", F.lit(name)), "rows", "k", F.col("v")))
    rows = reduce(DataFrame.unionByName, parts)
    each = rows.groupBy("figure").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("m"))
    return each.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("figure", F.to_json("m").alias("m"))))).alias("s")).select(
        F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("s"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ","), F.lit("}")).alias("stats")
    )
