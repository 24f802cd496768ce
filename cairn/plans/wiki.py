"""From wiki pages to documents: markup, concepts, gates; files, galleries and properties. Stand-ins: documents dressed in markup, orders and parts as files and concepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import wiki
from cairn.operators import gates, tasks

from .catalogue import query, table
from .texts import passages_sql

_HEAD = "{{Infobox|a={{b}}}}'''%s'''<ref name=x/><ref>r\n</ref> [[File:x.jpg|thumb]] [[檔案:y.png]][[Category:%s]] [[分类: %s ]] [[Target#part|shown]] [[target]] [[Star Wars: Episode IV]] [[en:Other]] [[d:Q%s]]"
_TAIL = "<gallery>\nFile:g.jpg|cap\n</gallery>\n===  [[Sub|Deep]] part ===\n{| table |}\nmore &amp;nbsp; [http://x/ site] text <!-- c -->\n\n\n== Empty ==\n"


def dressed() -> Column:
    parts = _HEAD.split("%s")
    filled = [F.lit(parts[0])]
    for value, rest in zip(("source", "lang", "source", "doc_id"), parts[1:], strict=True):
        filled += [F.col(value).cast("string"), F.lit(rest)]
    return F.concat(*filled, F.lit("\n==History==\n"), F.col("text"), F.lit("\n"), F.lit(_TAIL))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_PARTS = [_quoted(p) for p in _HEAD.split("%s")]
_DRESSED_HEAD = " || ".join(x for pair in zip(_PARTS, ("source", "lang", "source", "doc_id::VARCHAR", "''"), strict=True) for x in pair)
_DRESSED = f"{_DRESSED_HEAD} || chr(10) || '==History==' || chr(10) || text || chr(10) || {_quoted(_TAIL)}"


def clean_sql(t: str) -> str:
    """The SQL of `wikitext_clean`."""
    for pattern in wiki.BLANKED:
        t = f"regexp_replace({t}, '{pattern}', ' ', 'g')"
    for _ in range(3):  # as deep as the stand-ins nest
        t = f"regexp_replace({t}, '\\{{\\{{[^{{}}]*\\}}\\}}', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)\\[\\[(?:File|Image|文件|檔案|Category|分类|分類)[^\\]]*\\]\\]', ' ', 'g')"
    t = f"regexp_replace({t}, '\\[\\[(?:[^|\\]]*\\|)?([^\\]]+)\\]\\]', '\\1', 'g')"
    t = f"regexp_replace({t}, '\\[(?:https?://|ftp://)[^\\s\\]]+\\s+([^\\]]+)\\]', '\\1', 'g')"
    t = f"regexp_replace({t}, '''{{2,5}}', '', 'g')"
    t = f"regexp_replace({t}, '(?m)^\\s*={{1,6}}\\s*(.+?)\\s*={{1,6}}\\s*$', '\\1', 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', ' ', 'g')"
    for coded, plain in wiki.REFERENCES:
        t = f"replace({t}, {_quoted(coded)}, {_quoted(plain)})"
    return f"regexp_replace(regexp_replace(regexp_replace({t}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


@query(f"""
    SELECT doc_id, md5({clean_sql(_DRESSED)}) AS clean_md5, [lang, source] AS categories, ['Target', 'Star Wars: Episode IV', 'Sub'] AS links, 3 AS n_links, ['x.jpg', 'y.png'] AS files, 'Q' || doc_id AS qid, false AS disambiguation FROM documents""")
def wikitext_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dressed in wiki markup, cleaned and parsed."""
    t = dressed()
    parsed = table(spark, sf_dir, "documents").select("doc_id", F.md5(wiki.wikitext_clean(t).cast("binary")).alias("clean_md5"), wiki.wiki_lists(t).alias("l"))
    return parsed.select("doc_id", "clean_md5", "l.*")


@query(f"""
    SELECT doc_id, unnest([0, 1, 2, 3]) AS at, unnest(['', 'History', 'Deep part', 'Empty']) AS title, unnest([2, 2, 3, 2]) AS level, md5(unnest([{_DRESSED_HEAD} || chr(10),
        chr(10) || text || chr(10) || {_quoted(_TAIL[: _TAIL.index("===")])}, chr(10) || {_quoted(_TAIL[_TAIL.index("{|") : _TAIL.index("== Empty")])}, ''])) AS text_md5 FROM documents""")
def wiki_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(wiki.sections(dressed())).alias("at", "s"))
    return rows.select("doc_id", "at", "s.title", "s.level", F.md5(F.col("s.text").cast("binary")).alias("text_md5"))


_SIDE = "CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'zh' END"


@query(f"""
    WITH d AS (SELECT *, {_SIDE} AS side, 'T ' || doc_id AS title, 'Q' || doc_id // 2 AS qid, {clean_sql(_DRESSED_HEAD)} AS lead, {clean_sql("text || chr(10) || " + _quoted(_TAIL[: _TAIL.index("===")]))} AS history FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 7 <> 3 AND doc_id % 13 <> 5),
    m AS (SELECT *, '# ' || title || chr(10) || chr(10) || chr(10) || lead || chr(10) || chr(10) || '## History' || chr(10) || chr(10) || history || chr(10) || chr(10) || '## Deep part' || chr(10) || chr(10) || {clean_sql(_quoted(_TAIL[_TAIL.index("{|") : _TAIL.index("== Empty")]))} AS md FROM d)
    SELECT qid, side AS lang, 'https://' || side || '.wikipedia.org/wiki/T_' || doc_id AS url, sha256('https://' || side || '.wikipedia.org/wiki/T_' || doc_id) AS page_sha, sha256(md) AS content_sha, strlen(md)::INT AS page_bytes FROM m WHERE strlen(md) >= 400""")
def wiki_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The knowledge base's documents: pages with the concept that has them, without redirects (every eleventh), lists of meanings (two of thirteen) and pages of no concept."""
    docs, d = table(spark, sf_dir, "documents"), F.col("doc_id")
    pages = docs.select(
        F.expr(_SIDE).alias("lang"), d.alias("page_id"), F.concat(F.lit("T "), d).alias("title"), F.when(d % 11 == 0, "T 0").alias("redirect"),
        F.when(d % 13 == 5, F.concat(F.lit("{{Disambig}}"), dressed())).otherwise(dressed()).alias("text"),
    )
    of = F.floor(d / 2)
    side = lambda lang, i: F.struct(F.lit(lang).alias("lang"), F.when(i % 7 != 3, i).alias("page_id"))
    concepts = docs.select(of.alias("n"), F.concat(F.lit("Q"), of).alias("qid")).distinct()
    concepts = concepts.select("n", "qid", F.array(side("en", F.col("n") * 2), side("zh", F.col("n") * 2 + 1)).alias("sides"))
    out = tasks.wiki_documents(tasks.attach_concepts(pages, concepts, "n"))
    return out.select("qid", "lang", "url", "page_sha", "content_sha", "page_bytes")


@query(f"""
    WITH RECURSIVE {passages_sql("SELECT doc_id AS id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents")},
    k AS (SELECT id, count(*)::INT AS n FROM g GROUP BY id HAVING count(*) >= 2 OR max(length(t)) >= 150),
    u AS (SELECT d.*, replace(text, chr(10), chr(10) || chr(10)) AS t, k.n, sha256(CASE WHEN doc_id % 3 = 0 THEN 'offline:T' || doc_id ELSE 'http://h/' || doc_id END) AS page_sha FROM documents d JOIN k ON d.doc_id = k.id)
    SELECT doc_id, page_sha, 'pages/' || left(page_sha, 2) || '/' || page_sha || '.md' AS path, sha256(t) AS content_sha, strlen(t)::INT AS page_bytes, n AS n_passages, 'offline-dump' AS authority FROM u""")
def ingested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents taken in from outside; every third has no address. Those without enough passages stay out."""
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("T"), d).alias("title"), F.when(d % 3 != 0, F.concat(F.lit("http://h/"), d)).alias("url"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return tasks.ingested(rows).select("doc_id", "page_sha", "path", "content_sha", "page_bytes", F.size("passages").alias("n_passages"), "authority")


@query("""
    WITH f AS (SELECT c_custkey, c_custkey % 3 AS n FROM customer), e AS (SELECT c_custkey, i, 'Q' || c_custkey AS qid, 'F' || (c_custkey % 100) || ' ' || i || '.jpg' AS file FROM f, range(3) t(i) WHERE i < n),
    o AS (SELECT *, row_number() OVER (ORDER BY c_custkey, i) - 1 AS r FROM e WHERE c_custkey % 5 <> 2 OR i <> 0) SELECT r // 50 AS batch, qid, file FROM o""")
def file_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of fifty files that customers, as concepts, name; the first file of every fifth customer is held."""
    c, n = F.col("c_custkey"), (F.col("c_custkey") % 3).cast("int")
    name = lambda i: F.concat(F.lit("F"), c % 100, F.lit(" "), i, F.lit(".jpg"))
    link = lambda i: F.when(i == 0, F.concat(F.lit("<http://c/Special:FilePath/"), F.replace(name(i), F.lit(" "), F.lit("%20")), F.lit(">"))).otherwise(name(i))
    files = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), link)).otherwise(F.array().cast("array<string>"))
    concepts = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Q"), c).alias("qid"), files.alias("p18"))
    done = concepts.where(c % 5 == 2).select("qid", name(F.lit(0)).alias("file"))
    return tasks.file_tasks(concepts, done, "c_custkey")


_ONCE = "SELECT l_partkey, l_suppkey, min(l_orderkey * 10 + l_linenumber) AS line FROM lineitem WHERE {} GROUP BY 1, 2"


@query(f"""
    WITH t AS (SELECT *, row_number() OVER (ORDER BY line, 'Q' || l_partkey, 'S' || l_suppkey) - 1 AS r FROM ({_ONCE.format("l_returnflag IN ('R', 'A')")}))
    SELECT 'Q' || l_partkey AS qid, 'S' || l_suppkey AS file FROM t WHERE r % 4 = 1 AND l_partkey % 10 <> 0""")
def ledger_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard of four of the files that lines with two of the flags name; those of every tenth part are held."""
    ledger = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Q"), "l_partkey").alias("qid"), F.concat(F.lit("S"), "l_suppkey").alias("file"), F.col("l_returnflag").alias("tier"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")
    )
    done = ledger.where(F.substring("qid", 2, 20).cast("long") % 10 == 0).select("qid", "file")
    return tasks.ledger_tasks(ledger, done, "line", 1, 4, ("R", "A"))


@query(f"""
    WITH t AS (SELECT *, row_number() OVER (ORDER BY line, 'Q' || l_partkey, 'S' || l_suppkey) - 1 AS r FROM ({_ONCE.format("true")})) SELECT 'Q' || l_partkey AS qid, 'S' || l_suppkey AS file FROM t WHERE r % 3 = 2""")
def listed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard of three of a list of tasks, none held."""
    ledger = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("Q"), "l_partkey").alias("qid"), F.concat(F.lit("S"), "l_suppkey").alias("file"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"))
    return tasks.ledger_tasks(ledger, ledger.limit(0).select("qid", "file"), "line", 2, 3)


@query("""
    SELECT 'f' || l_suppkey AS file, arg_min(CASE WHEN l_partkey % 4 = 0 THEN 'pid:' || l_partkey ELSE 'Q' || l_partkey END, (l_orderkey * 10 + l_linenumber)) AS qid FROM lineitem GROUP BY 1""")
def embedded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first owner of each supplier, as an image of lines, as pages; every fourth page has no concept."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 4 != 0, F.concat(F.lit("Q"), "l_partkey")).alias("qid"), F.col("l_partkey").alias("page_id"), F.array(F.concat(F.lit("f"), "l_suppkey"), F.lit("")).alias("images"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")
    )
    return tasks.embedded_images(rows, "line")


@query("SELECT o_orderkey, 'F_' || o_orderkey AS file, o_totalprice AS size FROM orders WHERE o_orderkey % 3 <> 1")
def file_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a service tells of files that orders name; it spells them otherwise and lacks every third."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 1").select(F.concat(F.lit("File:f "), "o_orderkey").alias("title"), F.col("o_totalprice").alias("size"))
    return tasks.with_file_info(table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("F_"), "o_orderkey").alias("file")), orders)


@query("""
    WITH g AS (SELECT 'Q' || p_partkey AS qid, p_brand AS title FROM part)
    SELECT qid, unnest(['a ' || title || '.jpg', 'b.PNG']) AS file, unnest(['cap of ' || title, '']) AS caption FROM g WHERE title <> 'Brand#11'""")
def gallery_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and captions of the galleries of parts, one gallery a brand; every brand's page was redirected but for one that is missing."""
    part = table(spark, sf_dir, "part").select(F.concat(F.lit("Q"), "p_partkey").alias("qid"), F.col("p_brand").alias("title"))
    brands = part.select("title").distinct()
    now = F.concat(F.lit("Gallery_of "), "title")
    redirects = brands.where("title <> 'Brand#11'").select(F.col("title").alias("source"), now.alias("target"))
    text = F.concat(F.lit("<gallery>\n File: a_"), "title", F.lit(".jpg|1 = [[x|cap]] of ''"), "title", F.lit("''\nImage:b.PNG\nFile:a "), "title", F.lit(".jpg|again\n</gallery>"))
    files = F.array(F.concat(F.lit("File:a "), "title", F.lit(".jpg")), F.lit("File:b.PNG"), F.lit("File:b.PNG"), F.lit("File:c.pdf"))
    pages = brands.select(F.when(F.col("title") == "Brand#11", "Elsewhere").otherwise(now).alias("page"), files.alias("files"), text.alias("text")).withColumnRenamed("page", "title")
    return tasks.gallery_files(part, redirects, pages)


_PROP = "['P18', 'P41', 'P10', 'P999'][(o_orderkey % 4)::INT + 1]"


@query(f"""
    SELECT 'Q' || o_custkey AS qid, {_PROP} AS prop, ['representative', 'flag', NULL, 'other_image'][(o_orderkey % 4)::INT + 1] AS role, 'A ' || o_orderkey || '.jpg' AS file FROM orders WHERE o_orderkey % 4 <> 2 AND o_orderkey % 5 <> 0 AND o_custkey % 2 = 0""")
def image_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images among properties of customers with even numbers; every fifth file is a document."""
    triples = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Q"), "o_custkey").alias("qid"), F.expr("element_at(array('P18', 'P41', 'P10', 'P999'), CAST(o_orderkey % 4 + 1 AS INT))").alias("prop"),
        F.concat(F.lit("http://c/Special:FilePath/A_"), "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, ".pdf").otherwise(".jpg")).alias("value"),
    )
    concepts = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("Q"), "c_custkey").alias("qid"))
    return tasks.image_properties(triples, concepts)


@query("""
    SELECT doc_id, doc_id % 3 <> 0 AND doc_id % 5 <> 0 AS linked, n_chars > 300 AND doc_id % 4 <> 1 AS article, doc_id % 3 <> 1 AS image_line, n_chars > 6000 AND doc_id % 2 = 0 AS deep FROM documents""")
def page_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with site links, extracts that are articles, concepts of the image line, files worth a look."""
    d = F.col("doc_id")
    entity = F.when(d % 3 == 0, '{"missing":"", "sitelinks":{"enwiki":{}}}').when(d % 5 == 0, '{"sitelinks":{}}').otherwise('{"sitelinks":{"enwiki":{"title":"x"}}}')
    extract = F.concat(F.when(d % 4 == 1, "x 可以指 ").otherwise(""), F.substring(F.regexp_replace("text", "^\\s+|\\s+$", ""), 1, 1 << 30))
    extract = F.rpad(F.regexp_replace(extract, "\\s", "_"), F.col("n_chars").cast("int"), "_")
    carriers = F.when(d % 3 == 1, "text").when(d % 3 == 2, "image+text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", gates.has_sitelinks(entity).alias("linked"), gates.not_disambiguation(extract).alias("article"), gates.carried(carriers, "image").alias("image_line"),
        gates.deep_check(F.col("n_chars"), F.when(d % 2 == 0, "jpg").otherwise("pdf"), ("jpg", "png")).alias("deep"),
    )


#: Robots files: rules shared by agents, cut off by a blank line, of other agents, with codes, without a path; one that could not be read.
ROBOTS = [
    ("https://a.org", "# all\nUser-agent: other\nUser-agent: Cairn # us\nAllow: /private/open\nDisallow: /private\n\nUser-agent: *\nDisallow: /"),
    ("https://b.org", "User-agent: *\nDisallow:\n\nUser-agent: nobody\nDisallow: /\n"),
    ("http://c.org", "Disallow: /\nuser-agent:*\nCrawl-delay: 3\nDISALLOW: /find%3Fq=\nDisallow\nnoise: x\n\nDisallow: /find\n"),
    ("http://d.org", None),
    ("http://e.org", "User-agent: cairn\n\nDisallow: /\nUser-agent: *\nDisallow: /x%2"),
]


@query("""
    SELECT page_id, CASE page_id % 5 WHEN 0 THEN page_id % 2 = 0 WHEN 1 THEN true WHEN 2 THEN page_id % 4 <> 0 WHEN 3 THEN true ELSE page_id % 2 = 0 END AS allowed FROM pages""")
def robots_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which addresses a robot may fetch by the robots files of five hosts."""
    n = F.col("page_id")
    ways = [
        F.concat(F.lit("https://a.org/private/"), F.when(n % 2 == 0, "open/").otherwise(""), n), F.concat(F.lit("https://b.org/"), n), F.concat(F.lit("http://c.org/find?q"), F.when(n % 4 == 0, "=").otherwise("/"), n),
        F.concat(F.lit("http://d.org/"), n), F.concat(F.lit("http://e.org/x"), F.when(n % 2 == 0, "/").otherwise("%252"), n),
    ]
    pages = table(spark, sf_dir, "pages").select("page_id", F.get(F.array(*ways), (n % 5).cast("int")).alias("url"))
    files = spark.createDataFrame(ROBOTS, "origin string, body string")
    return gates.robots_allowed(pages, "url", gates.robots_rules(files, "cairn/1.0")).select("page_id", "allowed")


@query("SELECT page_id, url FROM pages WHERE regexp_extract(lower(url), '://([^/?#:]*)', 1) NOT IN (SELECT min(regexp_extract(lower(url), '://([^/?#:]*)', 1)) FROM pages)")
def hidden_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose host's digest is not on a list of digests; the list names the first host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    first = pages.agg(F.min(F.regexp_extract(F.lower("url"), "://([^/?#:]*)", 1)).alias("host")).select(F.md5(F.col("host").cast("binary")))
    return gates.not_listed(pages, "url", first)


@query("""
    SELECT sha, 'http://h/' || k AS url, 'pages/' || left(sha, 2) || '/' || sha || '.md' AS path, content_sha FROM (
        SELECT doc_id // 2 AS k, sha256('http://h/' || doc_id // 2) AS sha, sha256(arg_min(text, doc_id)) AS content_sha FROM documents WHERE doc_id % 4 <> 1 GROUP BY 1, 2) WHERE k % 7 <> 0""")
def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled pages, two to an address, of which one of four has no body; every seventh address is stored already."""
    d = F.col("doc_id")
    of = F.concat(F.lit("http://h/"), F.floor(d / 2))
    pages = table(spark, sf_dir, "documents").select(of.alias("url"), F.when(d % 4 == 1, " ").otherwise(F.col("text")).alias("body"), d.alias("at"), F.floor(d / 2).alias("k"))
    known = pages.where("k % 7 = 0").select(F.sha2("url", 256).alias("page_sha"))
    return tasks.crawled(pages, known).select(F.col("page_sha").alias("sha"), "url", "path", "content_sha")


@query("""
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size ELSE p_size * 10 END::INT AS width, ('0x' || left(sha256(p_name), 2))::INT % 7 AS reader, [30, 120, 300][least(p_size, 3)] AS wait FROM part""")
def fetch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose measured width goes before the declared one, the reader of each, and how long a refusal makes it wait."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", F.col("p_size").alias("width"), F.when(F.col("p_size") % 3 == 0, 0).otherwise(F.col("p_size") * 10).alias("actual"))
    out = tasks.projected_record(rows, {"width": "actual"})
    return out.select("p_partkey", "width", tasks.hash_route(F.sha2("p_name", 256), 7).alias("reader"), tasks.back_off(F.col("p_size") - 1).alias("wait"))


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'R'")
def stale_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of a ledger of all lines that a mirror without one flag lacks."""
    lines = table(spark, sf_dir, "lineitem")
    return tasks.retire_stale(lines, lines.where("l_returnflag <> 'R'"), ["l_partkey", "l_suppkey"])
