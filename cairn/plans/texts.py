"""Text functions over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import passages as P
from cairn.functions import text

from .catalogue import query, table


@query("SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS netloc, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def host_and_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.netloc(F.col("url")).alias("netloc"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'zh' ELSE 'latin' END AS tag, strlen(text)::INT AS bytes, md5(text) AS md5, sha256(text) AS sha256, greatest(1, ceil((doc_id % 200) * 1.6 / 56))::INT AS hint FROM documents""")
def text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of texts, the language tag of texts of which every third has a Chinese character, and how many results a quota asks for."""
    t = F.col("text")
    shown = F.when(F.col("doc_id") % 3 == 0, F.concat(t, F.lit("长"))).otherwise(t)
    hint = text.quota_hint((F.col("doc_id") % 200).cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.lang_tag(shown).alias("tag"), F.octet_length(t).alias("bytes"), F.md5(t.cast("binary")).alias("md5"), F.sha2(t, 256).alias("sha256"), hint.alias("hint")
    )


@query(r"SELECT page_id, regexp_replace(regexp_replace(url, '([?&])(?:(?:utm_[^=&#]*|ref|fbclid|gclid)=[^&#]*&?)+', '\1', 'g'), '[?&](#|$)', '\1', 'g') AS url FROM pages")
def tracker_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.strip_trackers(F.col("url")).alias("url"))


#: Rules of parameters to drop: address pattern, exceptions, parameter patterns.
TRACKERS = [(".*", ["https?://shop\\."], ["utm_[a-z]*", "ref$"]), ("https?://news\\.", [], ["s(id)?$"])]


@query("""
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://news.x/' || page_id || '?id=' || page_id || '#top' WHEN 1 THEN 'https://shop.x/?utm_a=1&ref=2&id=3' WHEN 2 THEN 'https://w.x/p?refs=2&q=a+b~' ELSE 'https://w.x/p?q' END AS url FROM pages""")
def tracker_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses cleaned by a table of rules: one that applies to all but shops, one to news alone."""
    kind, n = F.col("page_id") % 4, F.col("page_id").cast("string")
    url = F.when(kind == 0, F.concat(F.lit("https://news.x/"), n, F.lit("?utm_src=a&id="), n, F.lit("&sid=9&s=1&empty=#top")))
    url = url.when(kind == 1, "https://shop.x/?utm_a=1&ref=2&id=3").when(kind == 2, "https://w.x/p?refs=2&ref=3&q=a+b~").otherwise("https://w.x/p?q")
    return table(spark, sf_dir, "pages").select("page_id", text.clean_url(url, TRACKERS).alias("url"))


#: Visible text of `html`, as SQL: tags that open or close a block leave a blank line.
VISIBLE = "html"
for _pattern, _by in (
    ("(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->", "''"),
    ("(?i)</?(p|div|br|li|ul|ol|h[1-6]|article|section|nav|table|tr|header|footer)\\b[^>]*>", "chr(10) || chr(10)"),
    ("<[^>]*>", "''"),
):
    VISIBLE = f"regexp_replace({VISIBLE}, '{_pattern}', {_by}, 'g')"
for _coded, _plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):  # those that pages have
    VISIBLE = f"replace({VISIBLE}, '{_coded}', '{_plain}')"

_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_BLOCKS = f"list_filter(list_transform(string_split_regex({{}}, '\\n\\s*\\n'), lambda x: {_STRIP.format('x')}), lambda x: x <> '')"
_LINK, _IMAGE = P.LINK, P.IMAGE


def passages_sql(source: str) -> str:
    """CTEs that end in g(id, p, i): the passages of `source`(id, t), cut, marked and chosen, one a row, by their place."""
    bare = lambda x: f"length(regexp_replace({x}, '\\s+', '', 'g'))"
    no_links = f"regexp_replace(t, '{_LINK}', '', 'g')"
    return f"""
        b AS (SELECT id, {_BLOCKS.format("t")} AS b FROM ({source})),
        w AS (SELECT id, b, 0 AS k, '' AS buf, []::VARCHAR[] AS done FROM b UNION ALL
            SELECT id, b, k + 1, CASE WHEN length(j) >= 120 THEN '' ELSE j END, CASE WHEN length(j) >= 120 THEN list_append(done, j) ELSE done END
            FROM (SELECT *, CASE WHEN buf = '' THEN b[k + 1] ELSE buf || chr(10) || chr(10) || b[k + 1] END AS j FROM w WHERE k < len(b))),
        j AS (SELECT id, CASE WHEN buf = '' THEN done WHEN len(done) = 0 THEN [buf] ELSE list_append(done[:len(done) - 1], done[len(done)] || chr(10) || chr(10) || buf) END AS ps FROM w WHERE k = len(b)),
        c AS (SELECT id, unnest(ps) AS p, unnest(range(len(ps))) AS i FROM j),
        h AS (SELECT id, i, CASE WHEN length(p) <= 900 THEN p WHEN strpos(substr(p, length(p) // 2 + 1), '。') > 0 THEN left(p, length(p) // 2 + strpos(substr(p, length(p) // 2 + 1), '。')) ELSE left(p, length(p) // 2 + 1) END AS p FROM c),
        m AS (SELECT id, i, p, {_STRIP.format(f"replace(regexp_replace(p, '{_IMAGE}', '[图:' || chr(92) || '1]', 'g'), '[图:]', '[图:图]')")} AS t FROM h),
        g AS (SELECT id, t, len(list_filter(regexp_extract_all(p, '{_IMAGE}', 2), lambda x: NOT regexp_matches(x, '{P.JUNK}')))::INT AS n_images, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS i FROM m
            WHERE {bare('t')} = 0 OR ({bare(no_links)} / {bare('t')} >= 0.35 AND len(regexp_extract_all(t, '{_LINK}')) <= 15))"""


@query(f"WITH RECURSIVE {passages_sql(f'SELECT page_id AS id, {VISIBLE} AS t FROM pages')} SELECT id AS page_id, 'p' || i AS id, t AS text, n_images FROM g")
def passage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of the pages' visible text."""
    pages = table(spark, sf_dir, "pages").select("page_id", P.passages(text.html_to_text(F.col("html"))).alias("p"))
    return pages.select("page_id", F.explode("p").alias("p")).select("page_id", "p.id", "p.text", F.size("p.images").alias("n_images"))


_MARKED = "replace(text, chr(10), ' ![a](http://h/' || doc_id || '.jpg) ![](http://h/logo.png)' || chr(10) || chr(10)) || chr(10) || chr(10) || '[l](http://h/1) [m](http://h/2)'"


@query(f"WITH RECURSIVE {passages_sql(f'SELECT doc_id AS id, {_MARKED} AS t FROM documents')} SELECT id AS doc_id, i::INT AS at, md5(t) AS text_md5, n_images FROM g")
def image_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents with an image and a logo at the end of each line, and links at the end."""
    ends = F.concat(F.lit(" ![a](http://h/"), F.col("doc_id"), F.lit(".jpg) ![](http://h/logo.png)\n\n"))
    marked = F.concat(F.replace("text", F.lit("\n"), ends), F.lit("\n\n[l](http://h/1) [m](http://h/2)"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(P.passages(marked)).alias("at", "p"))
    return rows.select("doc_id", "at", F.md5(F.col("p.text").cast("binary")).alias("text_md5"), F.size("p.images").alias("n_images"))


_SENTENCES = "replace(replace(text, chr(10), chr(10) || chr(10)), '. ', '。')"


@query(f"""
    WITH RECURSIVE b AS (SELECT doc_id AS id, {_BLOCKS.format(_SENTENCES)} AS b FROM documents),
    w AS (SELECT id, b, 0 AS k, '' AS buf, []::VARCHAR[] AS done FROM b UNION ALL
        SELECT id, b, k + 1, CASE WHEN short THEN {_STRIP.format("buf || chr(10) || b[k + 1]")} ELSE b[k + 1] END, CASE WHEN short THEN done ELSE list_append(done, buf) END FROM (SELECT *, length(buf) + length(b[k + 1]) < 120 AS short FROM w WHERE k < len(b))),
    p AS (SELECT id, unnest(list_append(done, buf)) AS p, unnest(range(len(done) + 1)) AS i FROM w WHERE k = len(b)),
    c AS (SELECT id, i, 0 AS d, '' AS piece, p AS rest FROM p WHERE p <> '' UNION ALL
        SELECT id, i, d + 1, {_STRIP.format("left(rest, cut)")}, substr(rest, cut + 1) FROM (SELECT *, CASE WHEN contains(left(rest, 900), '。') AND 900 - strpos(reverse(left(rest, 900)), '。') > 60 THEN 901 - strpos(reverse(left(rest, 900)), '。') ELSE 900 END AS cut FROM c WHERE length(rest) > 900)),
    o AS (SELECT id, i, d, piece AS text FROM c WHERE d > 0 UNION ALL SELECT id, i, d + 1, rest FROM c WHERE length(rest) <= 900 AND rest <> '')
    SELECT id AS doc_id, (row_number() OVER (PARTITION BY id ORDER BY i, d) - 1)::INT AS pos, text FROM o""")
def wiki_passage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents whose lines are paragraphs and whose sentences end as Chinese ones do."""
    sentences = F.replace(F.replace("text", F.lit("\n"), F.lit("\n\n")), F.lit(". "), F.lit("。"))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(P.wiki_passages(sentences)).alias("pos", "text"))


@query(f"""
    WITH b AS (SELECT page_id, {_BLOCKS.format(VISIBLE)} AS b FROM pages),
    l AS (SELECT page_id, len(b) AS n, list_transform(b, lambda x: length(regexp_replace(regexp_replace(x, '{_LINK}', '', 'g'), '\\s+', '', 'g'))) AS p, list_transform(b, lambda x: length(regexp_replace(x, '\\s+', '', 'g'))) AS t FROM b),
    g AS (SELECT *, list_filter(p, lambda x: x >= 100) AS good, list_transform(list_zip(p, t), lambda x: x[1] / x[2]) AS r FROM l)
    SELECT page_id, n::INT AS n_blocks, len(good)::INT AS n_good, CASE WHEN len(good) > 0 THEN round(list_avg(good), 0) ELSE 0 END::DOUBLE AS avg_good_len, CASE WHEN n > 0 THEN round(list_avg(r), 3) ELSE 1 END::DOUBLE AS avg_link_ratio FROM g""")
def passage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", P.metrics(text.html_to_text(F.col("html"))).alias("m"))
    return pages.select("page_id", "m.*")


@query("""
    SELECT doc_id, CASE WHEN length(text) > 74 THEN left(text, 35) || '[...]' || right(text, 35) ELSE text END AS pretty, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed FROM documents""")
def prettified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with an ellipsis in the middle, and texts with single spaces."""
    return table(spark, sf_dir, "documents").select("doc_id", text.prettify(F.col("text")).alias("pretty"), text.squeeze(F.col("text")).alias("squeezed"))


@query("""
    SELECT doc_id, CASE WHEN n_chars > 1024 THEN printf('%.2f KB', n_chars / 1024.0) ELSE printf('%.2f B ', n_chars::DOUBLE) END AS size, printf('%02d:%02d', (n_chars % 3600) // 60, n_chars % 60) AS tail,
        CASE WHEN n_chars >= 3600 THEN n_chars % 86400 ELSE n_chars END AS seconds FROM documents""")
def size_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes as people write them, and as clocks read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text.human_bytes(F.col("n_chars")).alias("size"), text.clock_of(F.col("n_chars")).alias("clock"))
    return docs.select("doc_id", "size", F.right("clock", F.lit(5)).alias("tail"), text.seconds_of(F.col("clock")).alias("seconds"))


@query("SELECT o_orderkey, left(md5(name), 1) || '/' || left(md5(name), 2) || '/' || replace(name, '*', '%2A') AS path FROM (SELECT o_orderkey, 'F~*' || o_orderkey || '.jpg' AS name FROM orders)")
def upload_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.upload_path(F.concat(F.lit("F~*"), F.col("o_orderkey"), F.lit(".jpg"))).alias("path"))


_TRIPLE = "CASE o_orderkey % 3 WHEN 0 THEN {} WHEN 1 THEN {} ELSE {} END"


@query(f"""
    SELECT o_orderkey, {_TRIPLE.format("'Q' || o_orderkey", "o_orderpriority || '\"'", "'http://x/' || o_orderkey")} AS value, {_TRIPLE.format("'A+' || o_orderkey || ' c.jpg'", "'plain ' || o_orderkey", "'b.png'")} AS file,
        'https://en.wikipedia.org/wiki/A_' || o_orderkey || '/%C3%A9%2A~' AS page, {_TRIPLE.format("'jpg'", "'bin'", "'png'")} AS extension, 'a ' || o_orderkey AS title_key,
        {_TRIPLE.format("'10.1234/x' || o_orderkey", "'10.55555/y'", "NULL")} AS doi, {_TRIPLE.format("'JPG'", "'SVG'", "NULL")} AS format, strftime(TIMESTAMP '1970-01-01' + to_days((o_orderkey % 20000)::INT), '%m-%d') AS day,
        (o_orderkey % 4000) AS width, {_TRIPLE.format("o_orderkey % 300", "NULL", "NULL")}::INT AS number, {_TRIPLE.format("'bing'", "'meta_x'", "'other'")} AS source FROM orders""")
def file_and_link_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of triples, file names, page addresses, identifiers, formats and numbers, read from texts made for each order."""
    kind, n = F.col("o_orderkey") % 3, F.col("o_orderkey").cast("string")
    of = lambda a, b, c: F.when(kind == 0, a).when(kind == 1, b).otherwise(c)
    lit, cat = F.lit, F.concat
    triple = of(cat(lit("<http://w/entity/Q"), n, lit(">")), cat(lit('"'), F.col("o_orderpriority"), lit('\\""@en')), cat(lit("<http://x/"), n, lit(">")))
    link = of(cat(lit(" <http://c/Special:FilePath/A+"), n, lit("%20c.jpg> ")), cat(lit("File:plain "), n), lit("b.png"))
    paper = of(cat(lit("https://d.org/10.1234/x"), n, lit("/full/?a=1")), lit("https://d.org/get?doi=10.55555%2Fy.pdf%2F"), cat(lit("https://d.org/10.1/x"), n))
    alias = {"microsoft_bing": "bing"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.triple_value(triple).alias("value"), text.file_name(link).alias("file"), text.page_url(lit("en"), cat(lit("A "), n, lit("/é*~"))).alias("page"),
        text.safe_extension(of(lit("x.JPG"), lit("noext"), lit("y.png"))).alias("extension"), text.title_key(cat(lit(" A_"), n)).alias("title_key"), text.doi(paper).alias("doi"),
        text.image_format(of(lit("http://h/a.JPEG?x=1"), lit("http://h/b.svg"), lit("http://h/c"))).alias("format"), text.day_utc(F.col("o_orderkey") % 20000 * 86400).alias("day"),
        text.resolution(cat((F.col("o_orderkey") % 4000).cast("string"), lit(" x 20")))["width"].cast("long").alias("width"), text.int_or_null(of(cat(lit(" "), (F.col("o_orderkey") % 300).cast("string")), lit("x"), lit(None))).alias("number"),
        text.source_name(of(lit("Microsoft Bing"), lit(" Meta X"), lit("other")), alias).alias("source"),
    )


_REPLY = "8 + (doc_id % 5)"


@query("""
    WITH s AS (SELECT doc_id, least(10, doc_id % 15)::INT AS kb, (doc_id % 9)::INT AS rich, (doc_id % 7)::INT AS focus FROM documents WHERE doc_id % 4 <> 3 AND doc_id % 5 <> 4 AND n_chars >= 40)
    SELECT doc_id, kb, rich, focus, (doc_id % 2 = 0) AS identity, round((4 * kb + 4 * focus + 2 * rich) / 10, 1)::DOUBLE AS quality FROM s""")
def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations read from replies: scores over 10 count as 10; those without a boolean or with a short caption go."""
    d = F.col("doc_id")
    reply = F.concat(
        F.lit('Here: {"kb_match": '), (d % 15).cast("string"), F.lit(', "richness": '), (d % 9).cast("string"), F.lit(', "focus": '), (d % 7).cast("string"), F.lit(', "identity": '),
        F.when(d % 4 == 3, '"yes"').otherwise((d % 2 == 0).cast("string")), F.lit(', "caption": "'), F.when(d % 5 == 4, "short").otherwise(F.repeat(F.lit("c"), F.col("n_chars").cast("int"))), F.lit('"} end'),
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", text.annotation(reply).alias("a")).where("a is not null")
    return rows.select("doc_id", "a.kb", F.col("a.richness").alias("rich"), "a.focus", "a.identity", "a.quality")


@query("""
    SELECT doc_id, '实体：' || source || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '别名：a、b、c、d、' || lang || chr(10) ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN '知识：（暂无，仅凭实体名称判断）'
        ELSE '知识：' || left(trim(text), 250) || CASE WHEN length(trim(text)) > 250 THEN '…' ELSE '' END END AS block, CASE WHEN doc_id % 2 = 0 THEN ['Wall', 'b ' || lang] ELSE [] END AS latin FROM documents""")
def knowledge_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a judge is told of each source, with six aliases or none, with or without a description; and the Latin ones among aliases."""
    d, none = F.col("doc_id"), F.array().cast("array<string>")
    aliases = F.when(d % 2 == 0, F.array(*map(F.lit, "abcd"), F.col("lang"), F.lit("f"))).otherwise(none)
    names = F.when(d % 2 == 0, F.array(F.lit("Wall"), F.lit("墙"), F.lit("WALL"), F.concat(F.lit("b "), F.col("lang")))).otherwise(none)
    block = text.knowledge_block(F.col("source"), aliases, F.when(d % 3 != 0, F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", block.alias("block"), text.latin_aliases(names).alias("latin"))


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents")
def decoded_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts read back whose special and accented characters were written as references, by name, by number and in hexadecimal."""
    coded = F.col("text")
    for plain, told in (("&", "&amp;"), ("e", "&#x65;"), ("<", "&lt;"), (">", "&#62;"), ('"', "&quot;"), ("é", "&eacute;"), ("ü", "&#252;"), ("ö", "&#xF6;"), ("ñ", "&ntilde;")):
        coded = F.replace(coded, F.lit(plain), F.lit(told))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.html_unescape(coded).cast("binary")).alias("text_md5"))


@query(r"""
    WITH d AS (SELECT doc_id, text, regexp_extract(text, '^[^\x20\x09-\x0D]+') AS w FROM documents WHERE regexp_matches(text, '^[A-Za-z]{2,}[ \n]'))
    SELECT doc_id, md5(CASE WHEN contains(text, '<') THEN text ELSE regexp_replace(text, '(?i)\b(' || w || ')\b', '<span class="highlight">\1</span>', 'g') END) AS marked FROM d WHERE NOT regexp_matches(text, '[^\x00-\x7F]')""")
def highlighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of plain letters with every occurrence of their first word marked."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike("^[A-Za-z]{2,}[ \n]") & ~F.col("text").rlike("[^\\x00-\\x7F]"))
    first = F.regexp_extract("text", "^[^\\x20\\x09-\\x0D]+", 0)
    return docs.select("doc_id", F.md5(text.highlight(F.col("text"), F.concat(F.lit("'"), first, F.lit('" ')))).alias("marked"))
