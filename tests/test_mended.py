"""Trees, registries, histograms, references, quoting, robots files and caches against plain Python."""

from __future__ import annotations

import html
import random
import re
import urllib.parse
import urllib.robotparser
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cairn.functions import histograms, text
from cairn.operators import gates, tasks, trees
from cairn.sources import readers, sinks
from cairn.streaming import cache

TITLES = ["M*A*S*H", "a~b/c d", "é ü", "100% +x", "A_B.c-d", "長城", "'q' (x)!", "a&b=c?d#e"]


def test_addresses_are_quoted_as_in_python(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "t string")
    got = df.select("t", text.page_url(F.lit("en"), F.col("t")).alias("page"), text.upload_path(F.col("t")).alias("path"), text.percent_encoded(F.col("t")).alias("code")).collect()
    for r in got:
        assert r.page == "https://en.wikipedia.org/wiki/" + urllib.parse.quote(r.t.replace(" ", "_"))
        assert r.path.split("/", 2)[2] == urllib.parse.quote(r.t.replace(" ", "_"), safe="") and r.code == urllib.parse.quote(r.t, safe="")


REFERENCES = ["&#8212;", "&hellip;", "&#x1F600;", "&amp;lt;", "&#39;&apos;&quot;", "&nosuch; &", "&#150;&#x80;", "&#0;&#xD800;&#1114112;", "no &copy no", "&eacute;&Eacute;&AMP", "", "&;&#;&#x;", "a&#10;b", "&lt;&gt;&nbsp;|"]


def test_references_are_decoded_once(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*REFERENCES, None])], "i int, t string")
    got = {r.i: r.x for r in df.select("i", text.html_unescape(F.col("t")).alias("x")).collect()}
    bare = {"no &copy no", "&eacute;&Eacute;&AMP"}  # without a semicolon they stay
    assert got == {i: t if t in bare and "eacute" not in t else html.unescape(t.replace("&AMP", "&amp;AMP")) for i, t in enumerate(REFERENCES)} | {len(REFERENCES): None}
    page = "<p>caf&eacute; &mdash; a&nbsp;b &#8230;</p>"
    assert spark.range(1).select(F.trim(text.html_to_text(F.lit(page)))).first()[0].strip() == "café — a b …"


def plain_highlight(content, query):
    """Every occurrence of a word, case aside, marked."""
    if not content or "<" in content:
        return content
    alternatives = []
    for w in query.split():
        w = w.replace("'", "").replace('"', "")
        if w:
            alternatives.append(re.escape(w) if re.search("[一-鿿぀-ヿ가-힯ᄀ-ᇿ]", w) else rf"\b{re.escape(w)}(?!\w)")
    return re.sub("|".join(f"(?:{a})" for a in alternatives), lambda m: f'<span class="highlight">{m[0]}</span>', content, flags=re.I) if alternatives else content


@pytest.mark.parametrize(("content", "query"), [
    ("The cat and the Cats", "THE cat"), ("長城是長城", "長城 x"), ("a.b a+b axb", "a.b a+b"), (r"x\Ey x\E", r"x\E"), ("one <b>two</b>", "two"), ("quoted word", "'quoted\" \"\""), ("nothing", "  "), ("", "a"),
    ("élan Élan", "élan"), ("cost $5 $1", "$5"), ("a(b c[d", "a(b c[d"),
])
def test_highlight(spark, content, query):
    assert spark.range(1).select(text.highlight(F.lit(content), F.lit(query))).first()[0] == plain_highlight(content, query)


def test_tree_walk_takes_nodes_before_children_and_the_first_mount(spark):
    edges = [("r", "a", 1), ("r", "b", 0), ("a", "a1", 5), ("b", "b1", 0), ("b1", "b2", 0), ("b2", "b3", 0), ("a", "b1", 9)]
    walked = trees.walk_tree(spark.createDataFrame(edges, "parent string, node string, position int"), "r")
    rows = {(r.node, r.depth, r.branch) for r in walked.collect()}
    assert ("b3", 4, "b1") in rows and ("b1", 2, "b1") in rows and ("r", 0, "r") in rows and len(rows) == 7 and walked.count() == 10
    mounts = spark.createDataFrame([("b3", "x", 0), ("a", "x", 0), ("b1", "y", 2), ("a1", "z", 0), ("nowhere", "q", 0), ("r", "w", 0), ("b", "w", 0)], "node string, instance string, position int")
    assert {(r.instance, r.node, r.branch) for r in trees.first_mounts(walked, mounts).collect()} == {("x", "b3", "b1"), ("y", "b1", "b1"), ("z", "a1", "a1"), ("w", "r", "r")}
    with pytest.raises(ValueError, match="circle"):
        trees.walk_tree(spark.createDataFrame([("r", "a", 0), ("a", "r", 0)], "parent string, node string, position int"), "r", most=6)


def test_longest_prefix_against_a_table(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab/") for _ in range(rng.randrange(7)))
    nodes, paths = {word(): i for i in range(40)}, [word() for _ in range(300)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)] + [(-1, None)], "i int, path string")
    out = trees.prefix_join(df, "path", spark.createDataFrame(list(nodes.items()), "node string, target int"))
    assert "Nested" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        fits = [n for n in nodes if r.path is not None and (r.path.startswith(n) or n.startswith(r.path))]
        best = max(fits, key=lambda n: (len(n), n), default=None)
        assert (r.node, r.target) == (best, nodes.get(best))
    assert trees.prefix_join(df, "path", spark.createDataFrame([], "node string, target int")).where("node IS NOT NULL").count() == 0


def test_histograms_merge_and_clamp(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice([-3.0, 0.0, 0.4, 5.5, 19.9, 20.0, 500.0])) for k in "ab" for _ in range(101)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    parts = [histograms.histograms(df.where(cond), ["k"], "v", 2.0, 10) for cond in ("v < 5", "v >= 5")]
    got = {r.k: r for r in histograms.quantiles(parts[0].unionByName(parts[1]), ["k"], 2.0, {"p0": 0, "p50": 50, "p95": 95, "p100": 100}).collect()}
    assert sorted(got) == ["a", "b"]
    for k in "ab":
        values = [v for j, v in rows if j == k]
        buckets = sorted(min(9, max(0, int(v / 2.0))) for v in values)
        reach = lambda p, buckets=buckets: next(b for i, b in enumerate(buckets) if sum(x <= b for x in buckets) * 100 >= len(buckets) * p) * 2.0
        assert (got[k]["count"], got[k].p0, got[k].p50, got[k].p95, got[k].p100) == (101, 0.0, reach(50), reach(95), reach(100))
        assert abs(got[k].average - sum(values) / 101) < 1e-9
    shares = {(r.k, r["at"]): r.percent for r in histograms.shares(parts[0].unionByName(parts[1]), ["k"], 2.0).collect()}
    assert all(0 < p <= 100 for p in shares.values()) and all(a in (0.0, 4.0, 18.0) for _, a in shares)


ROBOTS = {
    "http://a": "User-agent: one\nUser-agent: Cairn/2\nDisallow: /p\nAllow: /p/q\n\nUser-agent: *\nDisallow: /",
    "http://b": "User-agent: *\nDisallow: /a%3cd.html\nDisallow: /a%2fb\nAllow: /\n# end", "http://c": "User-agent: cairn\nDisallow:\nUser-agent: *\nDisallow: /",
    "http://d": "User-agent: x\n\nDisallow: /\n\nUser-agent: *\nDisallow: /z # rest", "http://e": "Disallow: /\nnonsense\nUSER-AGENT: *\r\nDISALLOW: /y\r\nCrawl-delay: 1", "http://f": "", "http://g": "User-agent: *\nCrawl-delay: 9\n\nUser-agent: *\nDisallow: /q",
    "http://h": "User-agent: air\nDisallow: /air\n\nUser-agent: cairn\nDisallow: /cairn", "http://i": "User-agent: *\nUser-agent: zed\nDisallow: *\nAllow: /x", "http://k": "User-agent: *\nDisallow: /q?x=1",
}
PATHS = ["", "/", "/p", "/p/q", "/a%3Cd.html", "/a<d.html", "/a/b", "/z", "/y/x", "/q", "/q?x=1", "/air", "/cairn", "/x", "/é"]


def test_robots_files_as_the_standard_parser_reads_them(spark):
    files = spark.createDataFrame([*ROBOTS.items(), ("http://null", None)], "origin string, body string")
    urls = [o + p for o in [*ROBOTS, "http://null", "http://none"] for p in PATHS]
    got = {r.url: r.allowed for r in gates.robots_allowed(spark.createDataFrame([(u,) for u in urls], "url string"), "url", gates.robots_rules(files, "cairn/1.0")).collect()}
    for origin, body in ROBOTS.items():
        parser = urllib.robotparser.RobotFileParser()
        parser.parse(body.splitlines())
        for p in PATHS:
            assert got[origin + p] == parser.can_fetch("cairn/1.0", origin + p), (origin, p)
    assert all(got[o + p] for o in ("http://null", "http://none") for p in PATHS)


def test_ledger_refuses_blank_titles(spark, tmp_path):
    path = str(tmp_path / "ledger")
    sinks.append_manifest(spark.createDataFrame([(1, "a", "t"), (2, "b", " "), (3, "c", ""), (4, " ", "t"), (5, None, "t")], "n int, k string, title string"), path, ["k"], ["n"], required=("title",))
    assert [r.k for r in spark.read.parquet(path).collect()] == ["a"]


def test_rounds_and_fetch_lists(spark, tmp_path):
    rounds = [(0, 1, "p", ["b"], "2"), (0, 0, "p", ["a"], "1"), (0, 6, "p", ["z"], "z"), (0, 0, "q", None, None), (1, 0, "p", ["c"], "3")]
    got = tasks.merged_rounds(spark.createDataFrame(rounds, "batch int, round int, title string, files array<string>, text string")).collect()
    assert sorted((r.title, r.files, r.text) for r in got) == [("p", ["a", "b"], "12"), ("p", ["c"], "3"), ("q", [], "")]
    lines = [f"f{i}\tM{i}\tQ1:r\t{i}" if i % 3 else f"f{i}\tM{i}" if i % 2 else f"f{i}\tM{i}\tQ" for i in range(300)]
    (tmp_path / "list.tsv").write_text("\n".join(lines))
    valid = [line.split("\t") for line in lines if line.count("\t") >= 2]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        got = sorted((r.fname, r.size) for r in readers.fetch_list(spark, str(tmp_path / "list.tsv"), 2, 5).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((v[0], int(v[3]) if len(v) > 3 else 0) for i, v in enumerate(valid) if i % 5 == 2)


def test_cache_over_batches(spark, tmp_path):
    """Entries that lapse between two batches are gone, overwritten ones live on."""
    rows = [
        [("c", 0, "set", None, "k", "v1", 100), ("c", 0, "set", None, "m", "w", 100), ("c", 50, "get", 1, "k", None, None), ("d", 50, "get", 2, "k", None, None)],
        [("c", 90, "set", None, "k", "v2", 500), ("c", 80, "set", None, "k", "old", 900), ("c", 200, "get", 3, "k", None, None), ("c", 200, "get", 4, "m", None, None)],
        [("c", 5000, "get", 5, "k", None, None), ("c", 589, "get", 6, "k", None, None), ("c", 591, "get", 7, "k", None, None)],
        [("c", 6000, "get", 8, "k", None, None)],
    ]
    source, schema = str(tmp_path / "in"), "context string, s long, op string, id long, key string, value string, ttl long"
    for part in rows:
        spark.createDataFrame([(c, s + 10_000, *rest) for c, s, *rest in part], schema).withColumn("at", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(f"{schema}, at timestamp").option("maxFilesPerTrigger", 1).parquet(source).withWatermark("at", "10 seconds")
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    cache.cached(stream, 60).writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
    got = defaultdict(list)
    for r in spark.read.parquet(out).collect():
        got[r.id].append(r.value)
    assert got == {1: ["v1"], 2: [None], 3: ["v2"], 4: [None], 5: [None], 6: ["v2"], 7: [None], 8: [None]}
