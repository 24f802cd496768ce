"""Search results made from the documents: three engines list them, by language, at different places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.functions import text
from cairn.operators import adapters, gates, search

from .catalogue import query, table

#: An engine: its weight, the languages it lists, how far down it starts, and its form of a title and a text.
ENGINES = {
    "alpha": (1.0, ("en", "fr"), 1, "source", "text", "https"),
    "beta": (2.0, ("fr", "de"), 3, "source || ' ' || lang", "text || ' ' || source", "http"),
    "gamma": (0.5, ("en", "fr", "de", "es"), 5, "lang", "source", "http"),
}
#: Results of one query: documents of so many ids in a row.
PAGE = 20


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, parts = table(spark, sf_dir, "documents"), None
    for engine, (weight, langs, step, title, content, scheme) in ENGINES.items():
        part = docs.where(F.col("lang").isin(*langs)).select(
            F.floor(F.col("doc_id") / PAGE).alias("query"), F.lit(engine).alias("engine"), (F.col("doc_id") % PAGE + step).cast("int").alias("position"),
            F.concat(F.lit(f"{scheme}://example.org/"), F.col("doc_id")).alias("url"), F.expr(title).alias("title"), F.expr(content).alias("content"),
            F.lit("default.html").alias("template"), F.lit(None).cast("string").alias("img_src"), F.lit(weight).alias("weight"), F.col("lang").alias("category"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts.withColumn("query", F.col("query").cast("string"))


_PARTS = " UNION ALL ".join(
    f"SELECT (doc_id // {PAGE})::VARCHAR AS query, '{e}' AS engine, (doc_id % {PAGE} + {step})::INT AS position, doc_id, {w}::DOUBLE AS weight, {title} AS title, {content} AS content, '{scheme}' AS scheme, lang AS category"
    f" FROM documents WHERE lang IN ({', '.join(map(repr, langs))})"
    for e, (w, langs, step, title, content, scheme) in ENGINES.items()
)


_SERP = f"""
    SELECT query, max(scheme) || '://example.org/' || doc_id AS url, arg_max(title, length(title) * 1000 - position) AS title, arg_max(content, length(content) * 1000 - position) AS content,
        list_sort(list(DISTINCT engine)) AS engines, list_sort(list(position)) AS positions, arg_min(category, (position, engine)) AS category, arg_min(doc_id, position) AS doc_id,
        product(weight) * count(*) * sum(1 / position::DOUBLE) AS score FROM ({_PARTS}) GROUP BY query, doc_id"""


@query(f"SELECT query, url, title, md5(content) AS content_md5, engines, positions, round(score, 9) AS score FROM ({_SERP})")
def serp_merge_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = search.with_score(search.merge_results(results(spark, sf_dir)))
    return scored.select("query", "url", "title", F.md5(F.col("content").cast("binary")).alias("content_md5"), "engines", "positions", F.round("score", 9).alias("score"))


_RUNS = "STRUCT(g VARCHAR, items INT[])[]"


@query(f"""
    WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, 'default.html' || chr(1) || 'example.org/' || doc_id) - 1 AS r FROM ({_SERP})),
    w AS (SELECT query, 0 AS k, []::{_RUNS} AS runs FROM (SELECT DISTINCT query FROM s) UNION ALL
        SELECT query, k + 1, CASE WHEN last > 0 AND len(runs[last].items) <= 8 AND behind < 20
            THEN list_concat(list_concat(runs[:last - 1], [struct_pack(g := g, items := list_append(runs[last].items, k))]), runs[last + 1:]) ELSE list_append(runs, struct_pack(g := g, items := [k])) END::{_RUNS}
        FROM (SELECT *, coalesce(list_sum(list_transform(runs[last + 1:], lambda x: len(x.items))), 0) AS behind FROM (
            SELECT w.query, w.k, w.runs, s.category AS g, CASE WHEN list_contains(list_transform(w.runs, lambda x: x.g), s.category) THEN len(w.runs) + 1 - list_position(list_reverse(list_transform(w.runs, lambda x: x.g)), s.category) ELSE 0 END AS last
            FROM w JOIN s ON w.query = s.query AND w.k = s.r))),
    o AS (SELECT query, flatten(list_transform(runs, lambda x: x.items)) AS o FROM w QUALIFY row_number() OVER (PARTITION BY query ORDER BY k DESC) = 1),
    e AS (SELECT query, unnest(o) AS r, unnest(range(len(o))) AS place FROM o)
    SELECT query, url, title, round(score, 9) AS score, place FROM e JOIN s USING (query, r)""")
def serp_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = search.with_score(search.merge_results(results(spark, sf_dir))).withColumn("score", F.round("score", 9))
    return search.ordered_results(scored).select("query", "url", "title", "score", "place")


_ASKED = """
    SELECT *, CASE page_id % 3 WHEN 0 THEN split_part(t, ' ', 1) ELSE 'zzz' END AS name, CASE page_id % 3 WHEN 1 THEN trim(lower(split_part(t, ' ', 1) || ' ' || split_part(t, ' ', 2))) WHEN 2 THEN left(split_part(t, ' ', 2), 4) ELSE 'none' END AS alias,
        'https://' || CASE WHEN page_id % 5 = 0 THEN 'britannica.com' WHEN page_id % 5 = 1 THEN 'www.ebay.de' ELSE 'h.org' END || '/' || page_id // 2 AS address, CASE WHEN page_id % 9 = 0 THEN 'a disambiguation page' ELSE '' END AS snippet
    FROM (SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS t FROM pages)"""


#: A letter, digit or underscore of any script, which words are of, and any other sign.
_LETTER, _OTHER = "'[\\p{L}\\p{N}_]'", "'[^\\p{L}\\p{N}_]'"


@query(f"""
    WITH a AS ({_ASKED}),
    b AS (SELECT *, regexp_full_match(alias, '[A-Za-z0-9 .-]+') AND length(replace(alias, ' ', '')) < 5 AS short, len(string_split_regex(trim(split_part(t, '|', 1)), '\\s+')) <= 2 AS head FROM a),
    c AS (SELECT *, CASE WHEN t = name THEN 100 WHEN contains(t, name) THEN 70 WHEN alias = '' THEN 0 WHEN short THEN CASE WHEN head AND regexp_matches(t, '(?i)' || CASE WHEN alias[1] IN ('.', '-') THEN {_LETTER} ELSE '(?:^|' || {_OTHER} || ')' END || regexp_escape(alias) || CASE WHEN alias[-1] IN ('.', '-') THEN {_LETTER} ELSE '(?:$|' || {_OTHER} || ')' END) THEN 45 ELSE 0 END WHEN contains(lower(t), lower(alias)) THEN 55 ELSE 0 END
        + 6 * len(list_intersect(regexp_extract_all(lower(t), '[a-z]{{3,}}'), regexp_extract_all(lower(name || ' ' || alias), '[a-z]{{3,}}')))
        + CASE WHEN contains(address, 'britannica.com') THEN 8 ELSE 0 END - CASE WHEN contains(address, 'ebay.') THEN 40 ELSE 0 END - CASE WHEN snippet <> '' THEN 40 ELSE 0 END AS score FROM b),
    d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY page_id // 20, address ORDER BY page_id) = 1)
    SELECT page_id // 20 AS concept, page_id, score::INT AS score, row_number() OVER (PARTITION BY page_id // 20 ORDER BY score DESC, page_id, address) - 1 AS place FROM d WHERE score >= 18""")
def relevance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages scored against a name and an alias, twenty to a concept; of each address the first, if it scores 18 or more, in order."""
    n, lit = F.col("page_id"), F.lit
    pages = table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("t"))
    part = lambda i: F.coalesce(F.get(F.split("t", " "), lit(i)), lit(""))
    name = F.when(n % 3 == 0, part(0)).otherwise("zzz")
    alias = F.when(n % 3 == 1, F.lower(F.concat(part(0), lit(" "), part(1)))).when(n % 3 == 2, F.substring(part(1), 1, 4)).otherwise("none")
    host = F.when(n % 5 == 0, "britannica.com").when(n % 5 == 1, "www.ebay.de").otherwise("h.org")
    address = F.concat(lit("https://"), host, lit("/"), F.floor(n / 2))
    score = text.relevance(name, F.array(alias), F.col("t"), address, F.when(n % 9 == 0, "a disambiguation page").otherwise(""))
    scored = pages.select(F.floor(n / 20).alias("concept"), "page_id", address.alias("url"), n.alias("position"), score.alias("score"))
    return search.relevant(scored, "concept").select("concept", "page_id", "score", "place")


@query("""
    SELECT doc_id, source AS query, CASE WHEN doc_id % 300 < 100 THEN doc_id % 300 ELSE (doc_id % 300) / 1000.0 END::DOUBLE AS timeout, [lang] AS languages, ['images'] AS bangs, 'g' AS external, doc_id % 2 = 0 AS lucky,
        least(CASE WHEN doc_id % 300 < 100 THEN doc_id % 300 ELSE (doc_id % 300) / 1000.0 END, 60)::DOUBLE AS wait, '!a !b ' || source AS routed FROM documents""")
def query_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search texts taken apart, how long each may take, and the text that goes to two engines."""
    docs = table(spark, sf_dir, "documents")
    asked = F.concat(F.lit("!images :"), F.col("lang"), F.lit(" <"), F.col("doc_id") % 300, F.lit(" !!g "), F.col("source"), F.when(F.col("doc_id") % 2 == 0, " !!").otherwise(""))
    parsed = docs.select("doc_id", search.parse_query(asked, ("images", "general"), ("en", "de", "fr", "es")).alias("q")).select("doc_id", "q.*")
    return parsed.withColumns({"wait": search.timeout(F.lit(5.0), F.col("timeout"), F.lit(60.0)), "routed": search.routed(F.col("query"), F.array(F.lit("b"), F.lit("a"), F.lit("b")))})


#: A payload of each site with `{n}` for a number, and the address of its best candidate; a site's broken payload gives none.
PAYLOADS = {
    "wikimedia": ('{"query":{"pages":{"9":{"index":2,"pageid":9,"imageinfo":[{"url":"https://u/b"}]},"8":{"index":1,"pageid":8,"imageinfo":[{"url":"https://u/{n}"}]}}}}', "https://u/{n}", 2),
    "wikimedia_zh": ('{"query":{"pages":{"8":{"index":1,"pageid":8,"imageinfo":[{"url":"https://z/{n}"}]}}}}', "https://z/{n}", 1),
    "baidu": ('{"data":[{"middleURL":"","thumbURL":"https://b/{n}?w=500&h=889","width":"1"},{}]}', "https://b/{n}?w=500&h=889", 1),
    "anilist": ('{"data":{"Character":{"id":1,"name":{"full":"N"},"image":{"large":"https://l/{n}"}}}}', "https://l/{n}", 1),
    "mal": ('<a href="https://myanimelist.net/character/12/Foo_Bar">x</a>\n<img data-src="https://cdn/r/42x62/images/{n}.jpg">', "https://cdn/images/{n}.jpg", 1),
    "pixiv": ('{"body":{"illustManga":{"data":[{"id":"1","url":"https://i/c/250x250_80_a2/img-master/p/{n}_p0_square1200.jpg","illustType":2,"xRestrict":0},{"id":"2","url":"https://i/x","xRestrict":1}]}}}', "https://i/img-master/p/{n}_p0_master1200.jpg", 1),
    "bing_images": ('<a m="{&quot;murl&quot;:&quot;https://x.org/{n}.jpg&quot;,&quot;mw&quot;:10}" ><a m="{broken}" >', "https://x.org/{n}.jpg", 1),
    "yandex_images": ("{&quot;url&quot;:&quot;https://y.org/{n}.jpg&quot;,&quot;fileSizeInBytes&quot;:55,&quot;w&quot;:3,&quot;h&quot;:4}", "https://y.org/{n}.jpg", 1),
    "deviantart": ('<item><title>A</title><media:content url="https://w/{n}.jpg" height="5" width="6" medium="image"/></item><item></item>', "https://w/{n}.jpg", 1),
    "huaban_api": ('{"pins":[],"data":[{"file":{"key":"k{n}","width":9}},{"file":{}},{"file":{"key":"k{n}"}}]}', "https://hbimg.huaban.com/k{n}", 1),
    "toutiao": ('"https://q.org/pic.png" http://p.byteimg.com/x{n}.jpg https://q.toutiaoimg.com/y.jpg https://q.org/logo.png', "https://p.byteimg.com/x{n}.jpg", 2),
    "so360": ('{"list":[{"imgurl":"https://a/{n}","thumb":"https://a/t"},{"imgurl":"https://a/{n}","thumb":"https://a/t2"},{"imgurl":"https://a/{n}"}]}', "https://a/{n}", 2),
}
_SITES = ", ".join(f"({i}, '{s}', '{best}', {n})" for i, (s, (_, best, n)) in enumerate(PAYLOADS.items()))


@query(f"""
    SELECT doc_id, site, replace(best, '{{n}}', doc_id::VARCHAR) AS best, n FROM documents, (VALUES {_SITES}) v(k, site, best, n) WHERE (doc_id + k) % 5 <> 0""")
def adapter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best candidate and the number of candidates in the payloads of twelve sites for each document; one of five payloads is broken."""
    each = [F.struct(F.lit(i).alias("k"), F.lit(s).alias("source"), F.replace(F.lit(p), F.lit("{n}"), F.col("doc_id").cast("string")).alias("payload")) for i, (s, (p, _, _)) in enumerate(PAYLOADS.items())]
    payloads = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(*each)).alias("p")).select("doc_id", "p.source", F.when((F.col("doc_id") + F.col("p.k")) % 5 == 0, "broken").otherwise(F.col("p.payload")).alias("payload"))
    found = adapters.candidates(payloads, 5)
    return found.groupBy("doc_id", F.col("source").alias("site")).agg(F.min_by(F.get("tiers", F.lit(0)), "position").alias("best"), F.count("*").cast("int").alias("n"))


@query("""
    SELECT doc_id, failure FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'transient' WHEN 1 THEN 'deterministic' WHEN 2 THEN 'transient' END AS failure FROM documents)""")
def failed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which answers of sites are failures, to be tried again or not."""
    kind = F.col("doc_id") % 4
    source = F.when(kind == 0, "so360").when(kind == 1, "baidu").when(kind == 2, "pixiv").otherwise("bing_images")
    payload = F.when(kind == 0, "<html>").when(kind == 1, '{"antiFlag":1,"data":[]}').when(kind == 2, '{"error":true}').otherwise("<html>")
    return adapters.failures(table(spark, sf_dir, "documents").select("doc_id", source.alias("source"), payload.alias("payload"))).select("doc_id", "failure")


@query("""
    SELECT doc_id, place, CASE place WHEN 0 THEN ['https://i/' || doc_id, 'https://t/' || doc_id] ELSE ['https://t2/' || doc_id] END AS tiers, CASE place WHEN 0 THEN n_chars::INT END AS width, CASE place WHEN 0 THEN 'bing_images' END AS source FROM documents, range(2) r(place)""")
def image_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image candidates in two pages of results of each document; the second repeats the first's image and adds a thumbnail."""
    d = F.col("doc_id").cast("string")
    a = lambda p: F.concat(F.lit(f"https://{p}/"), d)
    first = F.struct(a("i").alias("img_src"), a("t").alias("thumbnail_src"), F.concat(F.col("n_chars").cast("string"), F.lit(" x 20")).alias("resolution"), F.lit("Bing Images").alias("engine"))
    second = F.struct(F.lit("").alias("img_src"), a("t2").alias("thumbnail_src"), F.lit("?").alias("resolution"), F.lit(None).cast("string").alias("engine"))
    nothing = F.struct(*[F.lit(None).cast("string").alias(n) for n in ("img_src", "thumbnail_src", "resolution", "engine")])
    page = lambda n, *rows: F.struct(F.lit(n).alias("pageno"), F.to_json(F.struct(F.array(*rows).alias("results"))).alias("payload"))
    pages = F.array(page(1, first, nothing), page(2, first, second), F.struct(F.lit(3).alias("pageno"), F.lit("broken").alias("payload")))
    payloads = table(spark, sf_dir, "documents").select(d.alias("query"), F.explode(pages).alias("p")).select("query", "p.*")
    found = search.image_candidates(payloads, 10)
    place = F.row_number().over(Window.partitionBy("query").orderBy("order")) - 1
    return found.select(F.col("query").cast("long").alias("doc_id"), place.cast("long").alias("place"), "tiers", "width", "source")


@query("""
    SELECT doc_id, 'https://p/' || doc_id AS page_url, left(text, 300) AS snippet, 'wiki' AS authority FROM documents UNION ALL SELECT doc_id, 'https://q/' || doc_id, NULL, 'serp' FROM documents""")
def text_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page candidates of text results: a page of an encyclopedia, one of a search, one again, and one beyond the three asked for."""
    d = F.col("doc_id").cast("string")
    row = lambda p, content, engine: F.struct(F.concat(F.lit(f"https://{p}/"), d).alias("url"), content.alias("content"), F.lit(engine).alias("engine"))
    none = F.lit(None).cast("string")
    rows = F.array(row("p", F.col("text"), "Wikipedia"), row("q", none, "bing"), row("p", none, "bing"), row("r", none, "bing"))
    payloads = table(spark, sf_dir, "documents").select(d.alias("query"), F.to_json(F.struct(rows.alias("results"))).alias("payload"))
    return search.text_candidates(payloads, 3).select(F.col("query").cast("long").alias("doc_id"), "page_url", "snippet", "authority")


@query("""
    SELECT source AS query, 'e' || max(doc_id % 7) AS engine, list_sort(list(DISTINCT 'u' || doc_id % 5)) AS urls, max(length(text))::INT AS longest, list_sort(list(DISTINCT 'l' || doc_id % 3)) AS labels FROM documents GROUP BY source""")
def infobox_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box a source, of boxes from seven engines; the heavier an engine, the later its number."""
    d = F.col("doc_id")
    label = F.array(F.struct(F.concat(F.lit("l"), d % 3).alias("label"), d.cast("string").alias("value")))
    boxes = table(spark, sf_dir, "documents").select(
        F.col("source").alias("query"), F.lit("box").alias("box_id"), F.concat(F.lit("e"), d % 7).alias("engine"), (d % 7).cast("double").alias("weight"), d.alias("position"), F.col("text").alias("content"),
        F.lit(None).cast("string").alias("img_src"), F.array(F.concat(F.lit("u"), d % 5)).alias("urls"), label.alias("attributes"),
    )
    merged = search.merge_infoboxes(boxes)
    return merged.select("query", "engine", F.array_sort("urls").alias("urls"), F.length("content").alias("longest"), F.array_sort(F.transform("attributes", lambda a: a["label"])).alias("labels"))


@query("""
    SELECT c_custkey, 'answer' AS kind, NULL AS title FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, 'result', trim(c_mktsegment) || '!' FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0""")
def answered_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that an answerer answers get no results; the others' results pass three plugins, of which one drops every fifth and one rewrites titles."""
    asked = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("title"))
    tried = asked.select("c_custkey", F.lit("statistics").alias("answerer"), F.when(F.col("c_custkey") % 3 == 0, F.lit("1")).alias("answer"))
    given, open_ = search.answered_or_asked(asked, "c_custkey", tried)
    results_ = search.through_plugins(open_, [(F.col("c_custkey") % 5 != 0, {}), (None, {"title": F.trim("title")}), (None, {"title": F.concat("title", F.lit("!"))})])
    return given.select("c_custkey", F.lit("answer").alias("kind"), F.lit(None).cast("string").alias("title")).unionByName(results_.select("c_custkey", F.lit("result").alias("kind"), "title"))


@query("""
    SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) <= CASE WHEN source = 'src1' THEN 3 ELSE 2 END * CASE WHEN lang = 'en' THEN 4 ELSE 1 END""")
def source_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first documents of each source and language: two, three for a source with a hint, four times as many in English, which stands for several engines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return search.source_slice(docs, "source", "lang", "doc_id", F.when(F.col("source") == "src1", 3).otherwise(2), F.when(F.col("lang") == "en", 4))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN ['b', 'c'] ELSE ['c'] END AS bangs FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, [] FROM part WHERE p_size % 3 = 0")
def live_bangs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bangs of the enabled ones among the engines of each part; parts of every third size have none, and one engine is off."""
    live = spark.createDataFrame([("e1", "c"), ("e2", "b"), ("e3", "c")], "engine string, bang string")
    engines = F.when(F.col("p_size") % 3 == 0, F.array().cast("array<string>")).when(F.col("p_size") % 2 == 0, F.array(F.lit("e1"), F.lit("e2"), F.lit("off"))).otherwise(F.array(F.lit("e3"), F.lit("e1")))
    return search.live_bangs(engines, live, table(spark, sf_dir, "part"), "p_partkey")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE trim(regexp_replace(text, '\\s+', ' ', 'g')) END AS content, CASE WHEN doc_id % 10 = 0 THEN 'low' WHEN doc_id % 10 = 1 THEN 'high' END AS priority,
        CASE WHEN doc_id % 10 = 2 THEN 'new.org' WHEN doc_id % 10 = 0 THEN 'low.org' WHEN doc_id % 10 = 1 THEN 'low.high.org' ELSE 'h.org' END AS host FROM documents WHERE doc_id % 10 <> 3""")
def host_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results by the rules for their hosts: one removed, one renamed, one low, one low and high; texts that repeat the title are blank."""
    d = F.col("doc_id") % 10
    host = F.when(d == 0, "low.org").when(d == 1, "low.high.org").when(d == 2, "old.org").when(d == 3, "spam.org").otherwise("h.org")
    title = F.when(F.col("doc_id") % 4 == 0, F.col("text")).otherwise("t")
    rows = table(spark, sf_dir, "documents").select("doc_id", text.result_content(title, F.col("text")).alias("content"), host.alias("host"))
    return gates.host_rules(rows, "host", ["spam"], [("^old", "new")], ["low"], ["high"])
