"""Markdown, addresses against a base, script objects; samples and shuffles by a seed."""

from __future__ import annotations

import json
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from cairn.functions import markup


def applied(spark, f, values, kinds="id int, a string"):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], kinds)
    return [r[0] for r in rows.orderBy("id").select(f(*[F.col(c) for c in rows.columns[1:]])).collect()]


MARKDOWN = {
    "[example](https://example.com)": "example",
    "## Headline": "Headline",
    "# A *b* ##\ntext\n\nTitle\n===\nmore": "A b text Title more",
    "**a *b* c** and ***d*** and *e **f** g* 2 * 3 * 4": "a b c and d and e f g 2 * 3 * 4",
    "__a__ _b c_ snake_case_name": "a b c snake_case_name",
    "> quoted\n> *more\n> words*": "quoted more words",
    "- one\n- two\n  1. three\n+ four": "one two three four",
    "a\n\n---\n\nb\n***\nc": "a b c",
    "`a *b* <c>` and ``d ` e`` \\*f\\* \\[g](h)": "a *b* <c> and d ` e *f* [g](h)",
    "x\n```python\nif *a*:\n\n    # b\n```\n*y*": "x if *a*: # b y",
    "~~~\nunclosed *x*": "unclosed *x*",
    "![alt](i.png) [![in](i.png)](u) [a b](<u v> \"t\") [c](u_(d)_e 't')": "a b c",
    "[one][r] [two][] [three] [four][none]\n\n[R]: http://x/ \"t\"\n[two]: <u>\n[three]: /u": "one two three [four][none]",
    "<https://a--b.c/_d_> <b>bold</b> <!-- no --> a<br/>b": "https://a--b.c/_d_ bold ab",
    "(c) (R) +- a... b?.... c!!!!! d,,,e f---g h -- i j--k": "© ® ± a… b?.. c!!! d,e f—g h – i j–k",
    "\"quoted\" it's 'single' \\\"kept\\\" a \"b": "“quoted” it’s ‘single’ \"kept\" a \"b",
    "&amp; &#233; \\&amp; `&lt;`": "& é &amp; &lt;",
    "`open *a*\n\nb` c": "`open a b` c",
    "": "",
    "\r\n \n": "",
}


def test_markdown_to_text(spark):
    got = applied(spark, markup.markdown_to_text, [*MARKDOWN, None])
    assert dict(zip(MARKDOWN, got)) == MARKDOWN and got[-1] is None


def test_long_markdown_needs_no_deep_stack(spark):
    long = 100_000
    texts = ["`" + "a\n" * long + "`", "- " * long + "x", ">" * long + " x", "```\n" + "b\n" * long + "```", "*" + "c " * long + "d*", "\\*" * long, "_" + "e " * long + "f_"]
    got = applied(spark, markup.markdown_to_text, texts)
    assert got[0] == ("a " * long).strip() and got[1] == "x" and got[2] == "x" and got[3] == ("b " * long).strip() and got[4] == "c " * long + "d" and got[5] == "*" * long and got[6] == "e " * long + "f"


def absolute(url, base):
    if url.startswith("//"):
        url = f"{urlparse(base).scheme or 'http'}:{url}"
    elif url.startswith("/") or "://" not in url:
        url = urljoin(base, url)
    parsed = urlparse(url)
    return None if not parsed.netloc else url if parsed.path else url + "/"


BASES = ("https://example.com", "http://a.b:8/c/d/e.html?x=1#f", "http://a/b/c/", "HTTP://A/b//c", "/path", "")
REFERENCES = (
    "", "/", "//h", "//h/x", "/p?a=1", "g", "./g", "../g", "../../g/", "../../../../g", "g/./h/../i", "g/.", "g/..", "..", ".", "?y=2", "#s", "?y#s", "g#s", "g;x=1", ";x", "https://o.p", "https://o.p?q",
    "mailto:a@b", "http:g", "ftp://f/x", "a//b", "/a/../b/./c//d", "g?u=v/../w", "foo?u=http://x", "é ü",
)


def test_addresses_against_a_base(spark):
    pairs = [(u, b) for b in BASES for u in REFERENCES]
    got = applied(spark, markup.absolute_url, pairs, "id int, u string, b string")
    assert {p: g for p, g in zip(pairs, got)} == {p: absolute(*p) for p in pairs}
    assert applied(spark, markup.absolute_url, [(None, "http://a"), ("b", None)], "id int, u string, b string") == [None, None]


SCRIPTS = {
    "{ a: 12, $b_1: .5, 'c': [1,2,], \"d\":-.5, e : 5., f:1_000.2_5,}": {"a": 12, "$b_1": 0.5, "c": [1, 2], "d": -0.5, "e": 5.0, "f": 1000.25},
    "[undefined, void 0, void(0), null, true, {undefined: 'undefined'}]": [None, None, None, None, True, {"undefined": "undefined"}],
    """{a:"f\\"irst", c:'sec"ond', d:`th"i'rd`, e:'it\\'s', f:"x:y, {z: .5}"}""": {"a": 'f"irst', "c": 'sec"ond', "d": "th\"i'rd", "e": "it's", "f": "x:y, {z: .5}"},
    "['\\x41\\u0042\\n\\\\', 'a\\\nb', `c\nd`, '\\q', '\\\\\\'']": ["AB\n\\", "ab", "c\nd", "q", "\\'"],
    "{k1_2: 'a_b', l: '1_000'}": {"k1_2": "a_b", "l": "1_000"},
}


def test_script_objects(spark):
    got = applied(spark, markup.script_json, [*SCRIPTS, "", " ", "{a:", "{a: 'open}", "function() {}", None])
    assert [json.loads(g) for g in got[: len(SCRIPTS)]] == list(SCRIPTS.values()) and got[len(SCRIPTS) :] == [None] * 6
    long = "x\\'" * 100_000
    assert json.loads(applied(spark, markup.script_json, [f"['{long}', `{'y' * 500_000}`]"])[0]) == [long.replace("\\", ""), "y" * 500_000]


@pytest.mark.parametrize("n", [0, 3, 500])
def test_seeded_sample(spark, n):
    from cairn.operators import control

    df = spark.range(200).selectExpr("id", "'x' AS mix", "id AS seeded")
    got = control.seeded_sample(df, "id", 7, n)
    ids = sorted(r.id for r in got.collect())
    assert got.columns == df.columns and len(set(ids)) == min(n, 200)
    assert ids == sorted(r.id for r in control.seeded_sample(df.repartition(7), "id", 7, n).collect())
    order = {r.id: r.r for r in control.seeded_order(df, "id", 7, "r").collect()}
    assert ids == sorted(i for i, r in order.items() if r < n)


def test_escaped_marks_are_taken_in_runs(spark):
    """A text that is mostly escapes is few pieces, not one for each mark; a run ends where a fence, code or an address may begin."""
    texts = {
        "\\*a\\_ b\\\\c\\\\\\*\nd\\. e": "*a_ b\\c\\* d. e",
        "x\\.\n  ```\n*y*\n```\n\\*z": "x. *y* *z",
        "\\`*a*\\` `b\\`c\\` \\<http://x> \\~~~": "`a` b\\c` <http://x> ~~~",
        "a\\.\u2028 ~~~\n*b*": "a.\u2028 *b*",
        "\\a \\\nb\\": "\\a b\\",
    }
    got = applied(spark, markup.markdown_to_text, list(texts))
    assert dict(zip(texts, got)) == texts
    pieces = applied(spark, lambda a: F.size(F.regexp_extract_all(a, F.lit(markup.LITERAL), F.lit(0))), ["\\*a \\_b\n" * 1000, "\\*\n```\n\\*"])
    assert pieces == [1, 2]
