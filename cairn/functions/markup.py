"""Markdown as plain text, addresses against a base, script objects as JSON: in built-in expressions."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, html_unescape, squeeze

#: What stands for a punctuation mark that means itself: the 32 code points that Unicode keeps out of texts.
MARKS = string.punctuation
STAND_INS = "".join(chr(0xFDD0 + i) for i in range(len(MARKS)))

#: One escaped mark. The class names each mark: Java looks single ones up in a table, but walks through ranges.
_MARK = r"\\[" + re.escape(MARKS) + "]"
#: A run of escaped marks with what lies between them, lines included, up to where anything else that is literal may begin: not beyond the blanks before a fence.
ESCAPED = rf"{_MARK}(?:[^\\`~<]++(?:(?![`~])|(?<![\n\r\x85\u2028\u2029] {{1,3}}))|{_MARK})*+"
#: What is literal in Markdown: escaped marks, a fenced block, a code span within a paragraph, an address in angle brackets.
#: Groups repeat possessively, so that long ones need no deep stack.
LITERAL = (
    rf"(?s){ESCAPED}|\\\n"
    r"|(?m:^) {0,3}(`{3,}|~{3,})[^`\n]*(?:\n.*?)??(?:(?m:^) {0,3}\1[`~]*[ \t]*(?=\n|\z)|\z)"
    r"|(?<!`)(`+)(?!`)(?:[^`\n]++|\n(?![ \t]*\n)|(?!(?<!`)\2(?!`))`)*+\2(?!`)"
    r"|<[A-Za-z][A-Za-z0-9+.-]{1,31}:[^\s<>]*>"
)
#: A definition that links refer to, on a line of its own.
DEFINITION = r"""(?m)^ {0,3}\[([^\[\]\n]+)\]:[ \t]*(?:<[^<>\n]*>|\S+)(?:[ \t]+(?:"[^"\n]*"|'[^'\n]*'|\([^()\n]*\)))?[ \t]*$"""
#: Where a link leads to, with or without a title.
TARGET = r"""\(\s*(?:<[^<>\n]*>|[^\s()<>]*(?:\([^\s()]*\)[^\s()<>]*){0,8})(?:\s+(?:"[^"]*"|'[^']*'|\([^()]*\)))?\s*\)"""

#: Marks of blocks, in the order they are taken off: quotes, rules, items, headings, underlines.
BLOCKS = (
    (r"(?m)^(?:[ \t]*>)++[ \t]?", ""), (r"(?m)^ {0,3}([-*_])(?:[ \t]*\1){2,}+[ \t]*$", "\n\n"), (r"(?m)^(?:[ \t]*(?:[-+*]|[0-9]{1,9}[.)])[ \t]+)++", "\n\n"),
    (r"(?m)^ {0,3}#{1,6}(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$", "\n\n$1\n\n"), (r"(?m)(?<=[^\n]\n)^ {0,3}(?:=+|-+)[ \t]*$", "\n\n"),
)
#: What typographers write for signs in ASCII, in this order. The first of three is part of all that the second matches, here and below.
REPLACEMENTS = (
    ("(", r"(?i)\(c\)", "©"), ("(", r"(?i)\(r\)", "®"), ("(", r"(?i)\(tm\)", "™"), ("+-", r"\+-", "±"), ("..", r"\.{2,}", "…"), ("…", "([?!])…", "$1.."),
    ("!", "([?!]){4,}+", "$1$1$1"), ("????", "([?!]){4,}+", "$1$1$1"), (",,", ",{2,}", ","),
    ("---", r"(^|[^-])---(?=[^-]|$)", "$1—"), ("--", r"(^|\s)--(?=\s|$)", "$1–"), ("--", r"(^|[^-\s])--(?=[^-\s]|$)", "$1–"),
    ('"', r"""(^|[\s(\[{—–])"(?=\S)([^"]*)(?<=\S)"(?=$|[\s)\]}.,:;!?—–])""", "$1“$2”"), ("'", r"(?<=\w)'(?=\w)", "’"),
    ("'", r"(^|[\s(\[{“—–])'(?=\S)([^']*)(?<=\S)'(?=$|[\s)\]}.,:;!?”—–])", "$1‘$2’"),
)
#: Emphasis, from the inside out.
_SINGLE = ("*", r"(?<!\*)\*(?![*\s])([^*]+)(?<![*\s])\*(?!\*)", "$1")
_UNDER = ("_", r"(?s)(?<!\w)(_{1,3})(?![\s_])(.+?)(?<![\s_])\1(?!\w)", "$2")
EMPHASIS = (_SINGLE, ("**", r"\*\*(?![*\s])([^*]+)(?<![*\s])\*\*", "$1"), _SINGLE, _UNDER, _UNDER)


def _spliced(text: Column, pattern: str, told) -> Column:
    """`text` with each match of `pattern` replaced by what `told` makes of it."""

    def spliced(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), told)
        return F.array_join(F.zip_with(F.split(t, pattern, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    return bound(text, spliced)


def _replaced(text: Column, steps) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def _found(text: Column, steps) -> Column:
    """As _replaced, of steps (sign, pattern, by): texts without the sign, which most are, meet no pattern."""
    for sign, pattern, by in steps:
        text = bound(text, lambda x: F.when(x.contains(sign), F.regexp_replace(x, pattern, by)).otherwise(x))  # noqa: B023
    return text


def _unescaped(run: Column) -> Column:
    """A run of escaped marks with the stand-in of each: that of the backslash first, so that every other backslash stands before the mark it escapes."""
    parts = F.split(F.replace(run, F.lit("\\\\"), F.lit(STAND_INS[MARKS.index("\\")])), "\\\\", -1)
    told = lambda p: F.concat(F.translate(F.substring(p, 1, 1), MARKS, STAND_INS), F.substr(p, F.lit(2)))
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(told(p))), "")


def markdown_to_text(markdown: Column) -> Column:
    """The visible text of Markdown, in single spaces: marks of blocks, emphasis and links out, images and tags gone, references decoded, quotes and dashes as typographers write them.

    Escaped marks, code and addresses in angle brackets stay as written. Links by reference count where the text defines
    them. Each line that begins as an item of a list is one; indented code is read as text.
    """

    def literal(piece: Column) -> Column:
        fenced = piece.rlike(r"^ {0,3}(?:`{3,}[^`\n]*|~{3,}[^`\n]*)(?:\n|\z)")
        inside = _replaced(piece, ((r"^ {0,3}[`~]{3,}[^\n]*\n?", ""), (r"\n? {0,3}[`~]{3,}[ \t]*\z", "")))
        bare = F.when(piece.startswith("<"), F.regexp_replace(piece, "^<|>$", "")).when(fenced, inside).otherwise(F.regexp_replace(piece, "^`+|`+$", ""))
        kept = F.translate(F.replace(bare, F.lit("\n"), F.lit(" ")), MARKS, STAND_INS)
        told = F.when(fenced, F.concat(F.lit("\n\n"), kept, F.lit("\n\n"))).otherwise(kept)
        return F.when(piece == "\\\n", " ").when(piece.startswith("\\"), _unescaped(piece)).otherwise(told)

    label = lambda t: F.lower(squeeze(t))

    def referred(block: Column, labels: Column) -> Column:
        of = lambda r, i: F.regexp_extract(r, r"^!?\[([^\[\]]*)\](?:\[([^\[\]]*)\])?$", i)
        named = lambda r: F.array_contains(labels, label(F.coalesce(F.nullif(of(r, 2), F.lit("")), of(r, 1))))
        shown = lambda r: F.when(~named(r), r).when(r.startswith("!"), "").otherwise(of(r, 1))
        return bound(block, lambda x: F.when((F.size(labels) > 0) & x.contains("["), _spliced(x, r"!?\[[^\[\]]*\](?:\[[^\[\]]*\])?", shown)).otherwise(x))

    def inline(block: Column, labels: Column) -> Column:
        linked = _found(block, (("![", rf"!\[[^\[\]]*\]{TARGET}", ""), ("](", rf"\[([^\[\]]*)\]{TARGET}", "$1")))
        untagged = _found(referred(linked, labels), (("<", "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->", ""), ("<", "</?[A-Za-z][^<>]*>", "")))
        told = html_unescape(_found(F.trim(untagged), (*REPLACEMENTS, *EMPHASIS)))
        # Whatever is found here has one of the marks.
        return F.when(block.rlike(f"[{re.escape(MARKS)}]"), told).otherwise(F.trim(block))

    def shown(lines: Column) -> Column:
        labels = F.transform(F.regexp_extract_all(lines, F.lit(DEFINITION), F.lit(1)), label)
        blocks = F.split(_replaced(F.regexp_replace(lines, DEFINITION, ""), BLOCKS), "\n[ \\t]*\n")
        return bound(labels, lambda known: F.array_join(F.transform(blocks, lambda x: inline(x, known)), " "))

    lines = _spliced(F.regexp_replace(markdown, "\\r\\n?", "\n"), LITERAL, literal)
    return F.translate(squeeze(bound(lines, shown)), STAND_INS, MARKS)


#: Scheme, host, path, query and fragment of an address or of a reference to one.
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, PARTS, i)


def joined_url(base: Column, reference: Column) -> Column:
    """What a reference in a page at `base` leads to: dot segments resolved, an empty reference is the base itself, one of another scheme or with a host stands as it is."""
    scheme, path, query = _part(reference, 1), _part(reference, 3), _part(reference, 4)
    own, of = F.lower(_part(base, 1)), F.split(_part(base, 3), "/")
    folder = F.when(F.element_at(of, -1) != "", F.slice(of, F.lit(1), F.size(of) - 1)).otherwise(of)
    merged = F.concat(folder, F.split(path, "/"))
    lean = F.filter(merged, lambda s, i: (s != "") | (i == 0) | (i == F.size(merged) - 1))
    steps = F.when(path.startswith("/"), F.split(path, "/")).otherwise(lean)
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.lit(0), F.size(done) - 1))
    walked = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(s == "..", up(done)).when(s == ".", done).otherwise(F.array_append(done, s)))
    whole = F.array_join(F.when(F.element_at(steps, -1).isin(".", ".."), F.array_append(walked, F.lit(""))).otherwise(walked), "/")
    rooted = F.when(path == "", _part(base, 3)).otherwise(whole)
    rooted = F.when((rooted != "") & ~rooted.startswith("/"), F.concat(F.lit("/"), rooted)).otherwise(rooted)
    asked = F.when((path == "") & (query == ""), _part(base, 4)).otherwise(query)
    mark = lambda sign, value: F.when(value != "", F.concat(F.lit(sign), value)).otherwise("")
    built = F.concat(own, F.lit("://"), _part(base, 2), F.when((rooted == "") & (path != ""), "/").otherwise(rooted), mark("?", asked), mark("#", _part(reference, 5)))
    stands = ((scheme != "") & (F.lower(scheme) != own)) | (_part(reference, 2) != "")
    return F.when(reference == "", base).when(stands, reference).otherwise(built)


def absolute_url(url: Column, base: Column) -> Column:
    """An address as a page at `base` names it, made absolute; a slash at the end if it has no path; null if it has no host, as that of a mail address."""
    hosted = F.concat(F.coalesce(F.nullif(F.lower(_part(base, 1)), F.lit("")), F.lit("http")), F.lit(":"), url)
    full = F.when(url.startswith("//"), hosted).when(url.startswith("/") | ~url.contains("://"), joined_url(base, url)).otherwise(url)
    return F.when(_part(full, 2) == "", None).when(_part(full, 3) == "", F.concat(full, F.lit("/"))).otherwise(full)


#: A string of a script, in quotes of three kinds.
STRING = "(?s)" + "|".join(rf"{q}[^{q}\\]*+(?:\\.[^{q}\\]*+)*+{q}" for q in "\"'`")
#: What scripts write unlike JSON outside strings: bare keys, no value, digits in groups, numbers that begin or end with the point, a comma at the end.
PLAIN = (
    (r"([{,]\s*)([A-Za-z_$][\w$]*)(?=\s*:)", '$1"$2"'), (r'(?<![\w$"])(?:void(?:\s+[0-9]+|\s*\(\s*[0-9]+\s*\))|undefined)(?![\w$"])', "null"),
    (r"(?:([\[,:]\s*-?)|\G(?!^))([0-9.]+)_(?=[0-9])", "$1$2"), (r"([\[,:]\s*-?)\.(?=[0-9])", "$10."), (r"([\[,:]\s*-?[0-9]+)\.(?![0-9])", "$1.0"), (r",(?=\s*[\]}])", ""),
)
#: Escapes that JSON has too.
ESCAPES = '"\\bfnrtu'


def script_json(script: Column) -> Column:
    """An object or list of a script as JSON; null where none comes out.

    Strings may stand in quotes of any kind; escapes that JSON lacks give their character, an escaped line end nothing.
    """

    def escaped(e: Column) -> Column:
        c = F.substring(e, 2, 1)
        return F.when(F.lit(ESCAPES).contains(c), e).when(c == "x", "\\u00").when(c == "\n", "").otherwise(c)

    def requoted(s: Column) -> Column:
        coded = _spliced(F.substr(s, F.lit(2), F.length(s) - 2), "(?s)\\\\.", lambda e: F.translate(escaped(e), '\\"', STAND_INS[:2]))
        for raw, told in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            coded = F.replace(coded, F.lit(raw), F.lit(told))
        return F.concat(F.lit('"'), F.translate(coded, STAND_INS[:2], '\\"'), F.lit('"'))

    between = F.transform(F.split(script, STRING, -1), lambda p: _replaced(p, PLAIN))
    strings = F.transform(F.regexp_extract_all(script, F.lit(STRING), F.lit(0)), requoted)
    json = F.trim(F.array_join(F.zip_with(between, strings, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))
    return bound(json, lambda j: F.when(F.try_parse_json(F.nullif(j, F.lit(""))).isNotNull(), j))
