from __future__ import annotations

import bz2
import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions import passages, text, wiki
from cairn.operators import gates, search
from cairn.operators.relational import append_new, first_wins, global_rank, prefix_route, rank_best_then_quota, reconcile, stride_shard
from cairn.sources import readers


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_merge_of_shards_drops_one(spark):
    rows = [("a", "甲", 0), ("b", "乙", 1), ("b", "乙", 2), ("b", "丙", 3), ("c", "甲", 4)]
    df = spark.createDataFrame(rows, "sha string, concept string, pos int")
    for n in (1, 7):
        assert {tuple(r) for r in first_wins(df.repartition(n), ["sha", "concept"], ["pos"]).collect()} == {rows[0], rows[1], rows[3], rows[4]}


def test_append_is_idempotent(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, pos int")
    new = append_new(batch.limit(0), batch, ["k"], ["pos"])
    assert {tuple(r) for r in new.collect()} == {("a", 1), ("b", 4)}
    assert append_new(new, batch, ["k"], ["pos"]).count() == 0


def test_global_rank_and_stride(spark):
    df = spark.createDataFrame([(i, float(random.Random(i).randint(0, 50))) for i in range(500)], "id int, v double")
    want = [r.id for r in sorted(df.collect(), key=lambda r: (r.v, r.id))]
    for n in (1, 7):
        ranked = global_rank(df.repartition(n), "v", ["id"], "r")
        assert [r.id for r in ranked.orderBy("r").collect()] == want
        assert {r.id for r in stride_shard(ranked, "r", 2, 5, offset=1, limit=3).collect()} == set(want[2::5][1:4])


def test_manifest_stages(spark):
    edges = [(1, f"f{i:02}", i, "normal", 1, 0) for i in range(31)] + [(1, "f00", 99, "preferred", 0, 1)]
    df = spark.createDataFrame(edges, "qid int, fname string, mid int, rank string, prio int, line int")
    out = rank_best_then_quota(df, "qid", "fname", F.col("prio"), ["line"], ["mid", "rank"], 30).collect()
    assert len(out) == 30 and max(r.fname for r in out) == "f29"
    assert next(r for r in out if r.fname == "f00").mid == 99


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 5), ("y", 5), ("z", 1)], "rel string, size int")
    b = spark.createDataFrame([("y", 6), ("z", 1), ("w", 5)], "rel string, size int")
    assert {r.rel: r.status for r in reconcile(a, b, "rel", "size", 2, 10).collect()} == {"x": "missing", "y": "size_mismatch", "z": "small", "w": "orphan"}


def test_prefix_route_takes_the_longest(spark):
    df = spark.createDataFrame([("a/b/c",), ("a",), ("q",)], "path string")
    got = {r.path: r.target for r in prefix_route(df, "path", [("a", "1"), ("a/b", "2")]).collect()}
    assert got == {"a/b/c": "2", "a": "2", "q": None}


def test_functions(spark):
    lit = F.lit
    r = one(
        spark, text.lang_tag(lit("长城 wall")).alias("zh"), text.quota_hint(lit(40)).alias("hint"), text.netloc(lit("https://u@h.org:80/p?q")).alias("host"),
        text.file_name(lit("<http://x/Special:FilePath/A+B%20c.jpg>")).alias("file"), text.triple_value(lit('"a\\"b"@en')).alias("lit"), text.triple_value(lit("<http://w/entity/Q42>")).alias("qid"),
        text.page_url(lit("en"), lit("A B/C")).alias("url"), text.magic_class(F.unhex(lit("FFD8FF00"))).alias("jpeg"), text.magic_class(lit("<html>Error: 429").cast("binary")).alias("html"),
        text.latin_aliases(F.array(lit("Wall"), lit("墙"), lit("wall"), lit("b"))).alias("aliases"), text.strip_trackers(lit("http://a/?utm_x=1&b=2&ref=3")).alias("strip"),
        text.resolution(lit("1920 x 1080")).alias("dims"), text.doi(lit("https://d.org/10.1234/ab.pdf")).alias("doi"), gates.error_body(lit("  <!DOCTYPE html>").cast("binary")).alias("bad"),
    )
    assert (r.zh, r.hint, r.host, r.file) == ("zh", 2, "u@h.org:80", "A+B c.jpg")
    assert (r.lit, r.qid, r.url, r.jpeg, r.html) == ('a"b', "Q42", "https://en.wikipedia.org/wiki/A_B/C", "jpeg", "html(429)")
    assert (r.aliases, r.strip, tuple(r.dims), r.doi, r.bad) == (["Wall", "b"], "http://a/?b=2", (1920, 1080), "10.1234/ab", True)


def test_bodies(spark):
    cases = {"<html>Error: 429": "html(429)", "<!DOCTYPE html><title> A </title>": "html(A)", "<html>x": "html(?)", "<p>hi": "html()", " <svg": "svg", "<?xml?><svg>": "xml", "BM123456789": "hex:424d313233343536", "AT&TFORMx": "djvu"}
    df = spark.createDataFrame([(k,) for k in cases], "b string")
    assert {r.b: r.c for r in df.select("b", text.magic_class(F.col("b").cast("binary")).alias("c")).collect()} == cases


def test_knowledge_block_and_doi(spark):
    block = lambda aliases, d: one(spark, text.knowledge_block(F.lit("墙"), F.array(*map(F.lit, aliases)).cast("array<string>"), F.lit(d).cast("string")))[0]
    assert block([], None) == "实体：墙\n知识：（暂无，仅凭实体名称判断）"
    assert block(["a", " b ", "", "c", "d", "e", "f"], "x" * 251) == "实体：墙\n别名：a、b、c、d、e\n知识：" + "x" * 250 + "…"
    doi = lambda u: one(spark, text.doi(F.lit(u)))[0]
    assert doi("https://d.org/10.1234/ab/full/") == "10.1234/ab" and doi("https://d.org/x?id=10.1234%2Fab.pdf") == "10.1234/ab" and doi("https://d.org/10.1/x") is None
    assert doi("https://d.org/10.1234/" + "x" * 60) is None


def test_marks_of_meanings(spark):
    score = text.relevance(F.lit("墙"), F.array().cast("array<string>"), F.lit("墙"), F.lit(""), F.col("s"))
    df = spark.createDataFrame([("可以指",), ("可以是指",), ("消歧义",), ("a disambiguation",), ("may refer to",)], "s string")
    assert [r[0] for r in df.select(score).collect()] == [60, 60, 60, 60, 100]


def test_annotation(spark):
    reply = 'text {"kb_match": 8, "richness": 7, "focus": 8, "identity": true, "caption": "%s"} end' % ("c" * 40)
    r = one(spark, text.annotation(F.lit(reply)).alias("a"), text.annotation(F.lit(reply.replace("true", '"yes"'))).alias("b"), text.annotation(F.lit(reply.replace("8", "42"))).alias("c"))
    assert (r.a.quality, r.b, r.c.kb) == (7.8, None, 10)


def test_relevance(spark):
    score = lambda title, url="", aliases=(): text.relevance(F.lit("螺栓"), F.array(*map(F.lit, aliases)) if aliases else F.array().cast("array<string>"), F.lit(title), F.lit(url), F.lit(""))
    r = one(spark, score("螺栓").alias("a"), score("x 螺栓 y", "https://zhihu.com/1").alias("b"), score("Ride with Bolt today", "", ("Bolt",)).alias("c"), score("Bolt", "https://bolt.eu", ("Bolt",)).alias("d"))
    assert (r.a, r.b, r.c, r.d) == (100, 78, 6, 45 + 6 - 40)


def test_passages(spark):
    page = "# T\n\n" + "a" * 130 + " ![x](http://h/p.jpg) ![logo](http://h/logo.svg)\n\nshort"
    nav = "\n\n".join(f"[l{i}](http://h/{i})" for i in range(40))
    r = one(spark, passages.passages(F.lit(page)).alias("p"), passages.passages(F.lit(nav)).alias("nav"), passages.passages(F.lit(None).cast("string")).alias("none"))
    assert len(r.p) == 1 and r.p[0].text.endswith("short") and [i.src for i in r.p[0].images] == ["http://h/p.jpg"]
    assert (r.nav, r.none) == ([], [])


WALL = (
    "'''长城'''是古代防御工程。\n[[Category:建筑]]\n[[分類:世界遗产]]\n[[d:Q35676]]\n==历史==\n建于[[春秋时期]]，参见[[战国]]与[[中国历史]]。\n"
    "===[[秦朝]]段落===\n连接细节。\n== 图片 ==\n[[File:Great Wall.jpg|thumb|长城]]\n[[檔案:Zhungguo map.png|地图]]\n==保护==\n[[UNESCO]]列入名录。链接重复去重：[[unesco]]。"
)


def test_page_of_a_wall(spark):
    r = one(spark, wiki.wiki_lists(F.lit(WALL)).alias("l"), wiki.sections(F.lit(WALL)).alias("s"), wiki.wikitext_clean(F.lit(WALL)).alias("c"))
    assert (r.l.categories, r.l.files, r.l.qid, r.l.disambiguation) == (["建筑", "世界遗产"], ["Great Wall.jpg", "Zhungguo map.png"], "Q35676", False)
    assert r.l.links == ["春秋时期", "战国", "中国历史", "秦朝", "UNESCO"] and r.l.n_links == 5
    assert [(s.title, s.level) for s in r.s] == [("", 2), ("历史", 2), ("秦朝段落", 3), ("图片", 2), ("保护", 2)]
    assert r.s[1].text == "\n建于[[春秋时期]]，参见[[战国]]与[[中国历史]]。\n" and r.s[2].text == "\n连接细节。\n"
    assert "==" not in r.c and "thumb" not in r.c and "历史\n建于春秋时期" in r.c


def test_wikitext(spark):
    raw = "{{Box|a={{b}}}}'''长城''' is [[Target#x|a wall]].<ref>no</ref> [[Category:建筑]] [[File:Great.jpg|thumb]]"
    r = one(spark, wiki.wikitext_clean(F.lit(raw)).alias("clean"), wiki.wiki_lists(F.lit(raw)).alias("lists"))
    assert r.clean == "长城 is a wall."
    assert (r.lists.categories, r.lists.files, r.lists.links) == (["建筑"], ["Great.jpg"], ["Target"])
    clean = lambda t: one(spark, wiki.wikitext_clean(F.lit(t)))[0]
    assert clean("a{{x}}b<!-- c -->d<gallery>\nF.jpg|x\n</gallery>e") == "a b d e"
    assert clean("== History ==\ntext\n\n\n\n&amp;lt; [http://x y z] ''i''\u3000") == "History\ntext\n\n< y z i"
    lists = lambda t: one(spark, wiki.wiki_lists(F.lit(t)))[0]
    assert lists("Q42 in prose").qid is None and lists("{{Wikidata|Q9358}}").qid == "Q9358" and lists("x{{Disambig}}").disambiguation
    assert lists("[[Star Wars: Episode IV]] [[en:Other]] [[#x]] [[ a ]] [[A|b]]").links == ["Star Wars: Episode IV", "a"]
    assert not lists("x" * 4000 + "{{disambig}}").disambiguation and lists("x（消歧义）").disambiguation
    none = one(spark, wiki.sections(F.lit("plain")).alias("a"), wiki.sections(F.lit("==A==")).alias("b"), wiki.sections(F.lit("== A =\nx\n=B=\n\n\ny")).alias("c"))
    assert [tuple(s) for s in none.a] == [("", 2, "plain")] and [tuple(s) for s in none.b] == [("A", 2, "")]
    assert [tuple(s) for s in none.c] == [("= A", 1, "\nx\n"), ("B", 1, "\ny")]


def test_captions(spark):
    raw = "<gallery>\nFile:A_b.jpg|1 = [[x|cap]] of ''it'' {{t}}\nImage: c.png\nfile:A b.jpg|again\n文件:d.gif|<b>e</b>\n</gallery>"
    assert [tuple(r) for r in one(spark, wiki.captions(F.lit(raw)))[0]] == [("A b.jpg", "cap of it"), ("c.png", ""), ("d.gif", "e")]


def test_wiki_passages(spark):
    """Blocks gather while short; a long one is cut after its last stop before 900, or at 900."""
    long = "x" * 500 + "。" + "y" * 600 + " " + "z" * 900
    texts = ["a\n\nb\n\n" + "c" * 130, "c" * 130 + "\n\nd", long, "", "q" * 50 + "。" + "r" * 1000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.p for r in df.select("i", passages.wiki_passages(F.col("t")).alias("p")).collect()}
    assert got[0] == ["a\nb", "c" * 130] and got[1] == ["c" * 130, "d"] and got[3] == []
    assert got[2] == ["x" * 500 + "。", "y" * 600 + " " + "z" * 299, "z" * 601] and got[4] == ["q" * 50 + "。" + "r" * 849, "r" * 151]


PAGE = """# 抛光不锈钢

抛光不锈钢是经机械/化学抛光处理的不锈钢材料，表面呈镜面效果，广泛用于
建筑装饰、厨具与雕塑。其耐腐蚀性与反光特性使它兼具工程与美学价值。

## 工艺

抛光分粗磨、中磨、精抛三步，依次用更细的磨料去除表面划痕。
![镜面效果示例](https://mock.cdn/mirror.png)
![logo图标](https://mock.cdn/logo.svg)

精抛后表面粗糙度可降至 Ra0.05 微米以下，形成接近镜面的反射。
![工艺流程图](https://mock.cdn/process.png?x=1)
"""


def test_page_binds_two_images(spark):
    found = one(spark, passages.passages(F.lit(PAGE)))[0]
    assert [i.src for p in found for i in p.images] == ["https://mock.cdn/mirror.png", "https://mock.cdn/process.png?x=1"]
    junk = one(spark, passages.passages(F.lit("x" * 130 + " ![](http://h/catalogo.jpg) ![a](http://h/sprite.png) ![](http://h/logo.png)")))[0]
    assert [i.src for i in junk[0].images] == ["http://h/catalogo.jpg"] and junk[0].text.endswith("[图:图] [图:a] [图:图]")


def test_results_merge_and_place(spark):
    rows = [("q", "a", 1, "http://x/1", "t", "c", "d", None, 1.0, "g"), ("q", "b", 3, "https://x/1", "longer", "", "d", None, 2.0, "g")]
    df = spark.createDataFrame(rows, "query string, engine string, position int, url string, title string, content string, template string, img_src string, weight double, category string")
    (r,) = search.with_score(search.merge_results(df)).collect()
    assert (r.url, r.title, r.content, r.engines, r.positions) == ("https://x/1", "longer", "c", ["a", "b"], [1, 3])
    assert r.score == pytest.approx(2.0 * 2 * (1 + 1 / 3))


def plain_order(groups):
    """Runs of one group; a result joins the last run of its group while that has had no more than eight joiners and fewer than 20 results stand behind it."""
    runs = []
    for i, g in enumerate(groups):
        at = max((k for k, (h, _) in enumerate(runs) if h == g), default=None)
        if at is not None and len(runs[at][1]) <= 8 and sum(len(r) for _, r in runs[at + 1 :]) < 20:
            runs[at][1].append(i)
        else:
            runs.append((g, [i]))
    return [i for _, r in runs for i in r]


def test_order_of_results(spark):
    cases = [list("abab"), [], list("a" * 25), list("ab" * 30), list("a" + "b" * 9 + "c" * 9 + "d" * 9 + "a")]
    cases += [[random.Random(i).choice("abcd") for _ in range(70)] for i in range(5)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, g array<string>")
    got = {r.i: r.o for r in df.select("i", search.placed(F.col("g")).alias("o")).collect()}
    assert got == {i: plain_order(c) for i, c in enumerate(cases)}
    assert got[0] == [0, 2, 1, 3]


def test_query_language(spark):
    r = one(spark, search.parse_query(F.lit("!images :fr_ch <850 !!g !nope hello"), ("images",), ("fr",)).alias("q")).q
    assert (r.query, r.timeout, r.languages, r.bangs, r.external, r.lucky) == ("!nope hello", 0.85, ["fr-CH"], ["images"], "g", False)


def test_payloads(spark):
    results = [{"img_src": "i1", "thumbnail_src": "t1", "resolution": "1920 x 1080", "url": "p", "engine": "Bing Images"}, {"img_src": "i2"}, {}, {"img_src": "i1"}]
    df = spark.createDataFrame([("q", 1, json.dumps({"results": results})), ("q", 2, "broken")], "query string, pageno int, payload string")
    out = search.image_candidates(df, 10).orderBy("order").collect()
    assert [r.tiers for r in out] == [["i1", "t1"], ["i2"]] and (out[0].width, out[0].source) == (1920, "bing_images")


def test_readers(spark, tmp_path):
    with gzip.open(tmp_path / "m.jsonl.gz", "wt") as f:
        f.write('{"sha": "a", "n": 1}\n\n{"broken\n{"sha": "b", "n": 2}\n')
    assert readers.manifest(spark, str(tmp_path / "m.jsonl.gz"), "sha string, n int").count() == 2
    assert readers.manifest(spark, str(tmp_path / "m.jsonl.gz"), "sha string, n int", corrupt="bad").where("bad is not null").count() == 1
    nt = '<http://w/entity/Q1> <http://w/prop/direct/P18> <http://c/Special:FilePath/a.jpg> .\n<http://w/entity/Q1> <http://w/prop/direct/P99> "x" .\n'
    (tmp_path / "t.nt").write_text(nt)
    assert [tuple(r) for r in readers.triples(spark, str(tmp_path / "t.nt"), ["P18", "P31"]).collect()] == [("Q1", "P18", "http://c/Special:FilePath/a.jpg")]
    page = lambda i, ns, t: f"<page><title>T{i}</title><ns>{ns}</ns><id>{i}</id><revision><id>9</id><text bytes=\"1\">{t}</text></revision></page>"
    dump = bz2.compress(f"<mediawiki>{page(1, 0, 'x')}".encode()) + bz2.compress(f"{page(2, 1, 'y')}{page(3, 0, 'z')}</mediawiki>".encode())
    (tmp_path / "d.xml.bz2").write_bytes(dump)
    assert {r.title for r in readers.wiki_dump(spark, str(tmp_path / "d.xml.bz2")).collect()} == {"T1", "T3"}
    (tmp_path / "b.json").write_text(json.dumps({"version": "2.1", "concepts": [{"name": "长城", "aliases": ["Great Wall", "长城"], "gate": "strict"}, {"name": "b", "min_images": 10}, {"name": "b"}]}))
    concepts = readers.concept_batch(spark, str(tmp_path / "b.json"))
    assert {r.name: r.min_images for r in concepts.collect()} == {"长城": 40, "b": 10}
    assert {(r.query, r.lang) for r in readers.concept_seeds(concepts).collect()} == {("长城", "zh"), ("Great Wall", "latin"), ("b", "latin")}
