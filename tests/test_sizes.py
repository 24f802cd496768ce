"""Rows that only large tables hold, against the SQL, and work that must not grow faster than its input."""

from __future__ import annotations

import html
import os

import duckdb
import pandas as pd
from compare import rows
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import search
from cairn.plans import catalogue, streams
from cairn.sources import readers
from cairn.streaming import cache


def held_against_sql(spark, folder, name: str, **tables) -> list:
    """The rows of a query over small tables, which must be those of its SQL."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = catalogue.QUERIES[name](spark, str(folder)).toPandas()
    assert rows(got) == rows(con.execute(catalogue.ORACLES[name]).fetchdf())
    return got.to_dict("records")


def page(title: str, before: str = "") -> str:
    return f'<!DOCTYPE html><html><head>{before}<title>{title}</title></head><body>x</body></html>'


def test_magic_classes_count_bytes(spark, tmp_path):
    """Titles of 80 characters in more bytes, and ones that end past the first 2048 bytes, are none."""
    bodies = [page("Geöä " * 16), page("é" * 40), page("é" * 41), page(""), page("Whole", "é" * 980), page("Cut", "é" * 1020), page("Error: 40", "é" * 1010), page("Error:\t503 é")]
    bodies.append(page("Geöä " * 16).replace("<body>", "<body><title>Later</title>"))
    pages = spark.createDataFrame([(12 * i + 1, "u", b) for i, b in enumerate(bodies)], "page_id long, url string, html string")
    got = {r["page_id"] // 12: r["class"] for r in held_against_sql(spark, tmp_path, "magic_classes", pages=pages)}
    assert got == {0: "html(?)", 1: f"html({'é' * 40})", 2: "html(?)", 3: "html()", 4: "html(Whole)", 5: "html(?)", 6: "html(?)", 7: "html(503)", 8: "html(Later)"}


def test_relevance_ends_words_at_letters_of_any_script(spark, tmp_path):
    """An alias of four letters is no word before an accented fifth one."""
    titles = ["Xyz abcdé | site", "Xyz abcd", "Xyz abcdé abcd", "éabcd abcdé", "Xyz abcd-é"]
    pages = spark.createDataFrame([(30 * i + 2, "u", page(t)) for i, t in enumerate(titles)], "page_id long, url string, html string")
    got = held_against_sql(spark, tmp_path, "relevance_top", pages=pages)
    assert {r["page_id"] // 30 for r in got if r["score"] >= 45} == {1, 4}


def test_tail_ledger_takes_no_more_batches_of_a_longer_log(spark, tmp_path, monkeypatch):
    """Many times the least batch in a log are still read in a few batches."""
    made = lambda _, name: f"{tmp_path}/{name}"
    monkeypatch.setattr(streams, "folder", made)
    monkeypatch.setattr(streams, "LEAST_BATCH", 256)
    monkeypatch.setattr(streams, "BATCHES", 3)
    events = spark.range(400).selectExpr("id AS event_id", "'click' AS event_type", "id % 7 AS user_id")
    assert len(held_against_sql(spark, tmp_path, "tail_ledger", events=events)) == 400
    assert 4 <= len([x for x in os.listdir(tmp_path / "offsets" / "commits") if x.isdigit()]) <= 9


def test_infoboxes_of_many_labels(spark):
    """The first of each address and label wins, and a box without addresses takes none from the others."""
    n = 3000
    boxes = [("q", "b", "e", 1.0, i, "c" * (i % 50), None, None if i % 9 == 0 else [f"u{i % 7}", f"v{i}"], [(f"l{i % 1500}", str(i)), (None, "x")]) for i in range(n)] + [("r", None, "e", 1.0, 0, None, None, None, None)]
    shape = "query string, box_id string, engine string, weight double, position long, content string, img_src string, urls array<string>, attributes array<struct<label:string,value:string>>"
    got = {r.query: r for r in search.merge_infoboxes(spark.createDataFrame(boxes, shape)).collect()}
    urls, labels = {}, {}
    for b in boxes[:n]:
        urls.update((u, None) for u in b[7] or () if u not in urls)
        labels.update((k, v) for k, v in b[8] if k is not None and k not in labels)
    assert got["q"].urls == list(urls) and [(a.label, a.value) for a in got["q"].attributes] == list(labels.items())
    assert len(got["q"].content) == 49 and got["r"].urls == [] and got["r"].attributes == []


class State(dict):
    """A map or list of the state store that counts how often it is asked."""

    calls = 0

    def _counted(self):
        self.calls += 1
        return self

    def containsKey(self, k):  # noqa: N802
        return k in self._counted()

    def getValue(self, k):  # noqa: N802
        return self._counted()[k]

    def updateValue(self, k, v):  # noqa: N802
        self._counted()[k] = v

    def appendValue(self, v):  # noqa: N802
        self._counted()[len(self)] = v

    def appendList(self, vs):  # noqa: N802
        for v in vs:
            self.appendValue(v)

    def exists(self):
        return bool(self)

    def get(self):
        return iter(self.values())


class Handle:
    def __init__(self):
        self.map, self.list, self.timers = State(), State(), []

    def getMapState(self, *_):  # noqa: N802
        return self.map

    def getListState(self, *_):  # noqa: N802
        return self.list

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


def test_cache_asks_its_state_once_for_many_rows():
    """A bundle of rows asks for each of its keys, not for each row."""
    n, keys = 4000, 3
    sets = pd.DataFrame({"op": "set", "key": [f"k{i % keys}" for i in range(n)], "at": range(n), "id": -1, "value": [f"{i:05}" for i in range(n)], "expire": [i + 10 if i % keys else 10**6 for i in range(n)]})
    gets = pd.DataFrame({"op": "get", "key": [f"k{i % (keys + 1)}" for i in range(n)], "at": range(2000, 2000 + n), "id": range(n), "value": None, "expire": 0})
    shuffled = pd.concat([sets, gets]).sample(frac=1, random_state=3)
    processor, handle = cache.ContextCache(1.0), Handle()
    processor.init(handle)
    got = pd.concat(list(processor.handleInputRows(("c",), iter([shuffled[:3000], shuffled[3000:]]), None)))
    last = {f"k{k}": max(i for i in range(n) if i % keys == k) for k in range(keys)}
    want = {g.id: f"{last[g.key]:05}" if g.key in last and (last[g.key] + 10 if last[g.key] % keys else 10**6) > g.at else None for g in gets.itertuples()}
    assert dict(zip(got["id"], got["value"], strict=True)) == want and not handle.list.clear()
    assert handle.map.calls < 100 and handle.list.calls < 10 and len(handle.timers) < 20


def test_references_are_told_once_each(spark):
    """Few distinct references or many in a text: each is decoded, and a list of few values tells each value once."""
    texts = ["&#x65;&amp;" * 500 + "&#233;", "".join(f"&#{i};" for i in range(300, 420)) * 2, "none", ""]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(text.html_unescape(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [html.unescape(t) for t in texts]
    drawn = text.told_once(F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: (i % 3).cast("string")), lambda x: F.concat(x, F.uuid()))
    assert len(set(spark.range(1).select(drawn.alias("x")).first().x)) == 3


def test_fetch_lists_in_several_files_without_a_sort(spark, tmp_path):
    """Files in the order of their names are one list, read in ranges of any length."""
    lines = [f"f{i}\tM{i}\tQ1:r\t{i}" if i % 5 else f"short\t{i}" for i in range(400)]
    for k in range(4):
        (tmp_path / f"part-{k}").write_text("\n".join(lines[100 * k : 100 * (k + 1)]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        found = readers.fetch_list(spark, str(tmp_path), 1, 4, one=True)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(r.fname for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(x.split("\t")[0] for x in [x for x in lines if x.count("\t") == 3][1::4])
    assert "row_number" not in plan
