"""Markup: Markdown as text, addresses of pages made absolute, objects of scripts as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import markup

from .catalogue import query, table

_SQUEEZED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query(f"""
    SELECT doc_id, md5(trim('Doc ' || doc_id || ' of ' || source || ' “' || lang || '” – it’s one ' || {_SQUEEZED}) || ' if *x* & y: … end') AS text_md5 FROM documents""")
def markdown_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Markdown, read back as text: a heading, emphasis, a link and an item, the whole text with its marks escaped, code and a reference."""
    d, lit, cat = F.col("doc_id").cast("string"), F.lit, F.concat
    escaped = F.regexp_replace("text", r"([!-/:-@\[-`{-~])", r"\\$1")
    head = cat(lit("# Doc **"), d, lit("** of [*"), "source", lit('*](<http://x/'), d, lit('> "t") ##\n![img](i.png)\n* "'), "lang", lit("\" -- it's [one][R]\n\n"))
    marked = cat(head, escaped, lit("\n\n```py\nif *x* & y:\n```\n... &#101;nd\n\n[r]: http://y/ 't'\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(markup.markdown_to_text(marked).cast("binary")).alias("text_md5"))


#: References as pages hold them, and what each leads to from an address http(s)://host/lang/number…, by its scheme, site and folder.
REFERENCES = (
    ("//cdn.x", "scheme || '://cdn.x/'"), ("?q=1#s", "site || path || '?q=1#s'"), ("k/./a/../z", "site || folder || 'k/z'"), ("../../../up", "site || '/up'"), (".", "site || folder"),
    ("", "CASE WHEN path = '' THEN url || '/' ELSE url END"), ("https://b.org?x", "'https://b.org?x/'"), ("mailto:a@b.org", "NULL"),
)


@query(rf"""
    WITH u AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://[^/?#]*') AS site, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
    v AS (SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END AS folder FROM u),
    r AS ({' UNION ALL '.join(f"SELECT page_id, '{ref}' AS href, {told} AS link FROM v" for ref, told in REFERENCES)}
        UNION ALL SELECT page_id, href, site || href FROM (SELECT page_id, site, unnest(regexp_extract_all(html, 'href="(/[^"/#?][^"]*)"', 1)) AS href FROM v))
    SELECT page_id, href, link, count(*)::BIGINT AS n FROM r GROUP BY ALL""")
def absolute_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the links of pages lead to, with eight more forms of reference on each page."""
    hrefs = F.concat(F.array(*[F.lit(r) for r, _ in REFERENCES]), F.regexp_extract_all("html", F.lit('href="(/[^"/#?][^"]*)"'), F.lit(1)))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(hrefs).alias("href"))
    return pages.groupBy("page_id", "href", markup.absolute_url(F.col("href"), F.col("url")).alias("link")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, source, md5(text) AS text_md5, n_chars + 0.5::DOUBLE AS size, NULL::VARCHAR AS gone, [1, 1000]::BIGINT[] AS parts FROM documents WHERE doc_id % 10 <> 9")
def script_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as objects of a script, in quotes of each kind, read as JSON; one of ten is cut short."""
    d, lit, cat = F.col("doc_id"), F.lit, F.concat
    quote = F.get(F.array(lit("'"), lit('"'), lit("`")), (d % 3).cast("int"))
    escaped = F.replace("text", lit("\\"), lit("\\\\"))
    for raw in "'\"`":
        escaped = F.when(quote == raw, F.replace(escaped, lit(raw), lit("\\" + raw))).otherwise(escaped)
    escaped = F.replace(F.replace(escaped, lit("\r"), lit("\\r")), lit("\n"), F.when(d % 2 == 0, "\\n").otherwise("\\\n\\n"))
    script = cat(lit("{id: "), d.cast("string"), lit(", $source:'"), "source", lit("', 'text' :"), quote, escaped, quote, lit(", size: "), F.col("n_chars").cast("string"), lit(".5, gone: void 0, parts: [1, 1_000,],}"))
    script = F.when(d % 10 == 9, F.substr(script, lit(1), F.length(script) - 2)).otherwise(script)
    read = F.from_json(markup.script_json(script), "id long, `$source` string, text string, size double, gone string, parts array<long>")
    rows = table(spark, sf_dir, "documents").select(read.alias("r")).where("r is not null")
    return rows.select(F.col("r.id").alias("doc_id"), F.col("r.$source").alias("source"), F.md5(F.col("r.text").cast("binary")).alias("text_md5"), "r.size", "r.gone", "r.parts")
