"""Wiki markup: plain text, sections, links, and pages as Markdown.

Patterns read white space as Unicode has it, and only a line feed ends a line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .passages import strip, wiki_passages

#: Prefixes of links to categories, files and other wikis; marks of disambiguation pages in the text and in its title.
CATEGORY = ("Category:", "category:", "CAT:", "分类:", "分類:")
FILE = ("File:", "file:", "Image:", "image:", "IMAGE:", "文件:", "檔案:")
OTHER_WIKIS = ("d:", "wikidata:", "w:", "en:", "zh:", "commons:", "meta:", "m:", "s:", "q:", "b:", "v:", "c:")
DISAMBIGUATION, DISAMBIGUATION_TITLE = ("{{disambig", "{{消歧义", "{{消歧義"), ("（消歧义）", "（消歧義）", "(消歧义)")
#: How far the marks are looked for, and the most links of a page.
TEXT_HEAD, TITLE_HEAD, MOST_LINKS = 4000, 200, 2000
#: Patterns of the markup, and character references in the order in which they are decoded.
HEADING = "(?mdU)^(={1,6})\\s*(.+?)\\s*\\1\\s*$"
LINK = "\\[\\[([^\\[\\]|]+)(?:\\|[^\\[\\]]*)?\\]\\]"
SHOWN_LINK = "\\[\\[(?:[^\\[\\]|]+\\|)?([^\\[\\]|]+)\\]\\]"
QID_LINK, QID_TEMPLATE = "(?iU)\\[\\[(?:d|wikidata):\\s*(Q\\d+)", "(?U)\\{\\{[Ww]ikidata\\|\\s*(Q\\d+)"
BLANKED = (
    "(?is)<ref[^>]*?/>|<ref[^>]*?>.*?</ref>",
    "(?s)<!--.*?-->",
    "(?s)\\{\\|.*?\\|\\}",
    "(?is)<gallery.*?</gallery>",
)
REFERENCES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))


def wikitext_clean(text: Column, rounds: int = 8) -> Column:
    """Plain text of wiki markup.

    References, comments, tables, galleries, templates (from the inside out, up to `rounds` deep),
    links to files and categories and tags leave a blank; other links leave what they
    show; emphasis and the marks of headings go. Blanks are joined, blank lines too, and the ends
    are stripped.
    """
    out = text
    for pattern in BLANKED:
        out = F.regexp_replace(out, pattern, " ")
    out = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), out, lambda t, _: F.regexp_replace(t, "\\{\\{[^{}]*\\}\\}", " "))
    out = F.regexp_replace(out, "(?i)\\[\\[(?:File|Image|文件|檔案|Category|分类|分類)[^\\]]*\\]\\]", " ")
    out = F.regexp_replace(out, "\\[\\[(?:[^|\\]]*\\|)?([^\\]]+)\\]\\]", "$1")
    out = F.regexp_replace(out, "(?U)\\[(?:https?://|ftp://)[^\\s\\]]+\\s+([^\\]]+)\\]", "$1")
    out = F.regexp_replace(out, "'{2,5}", "")
    out = F.regexp_replace(out, "(?mdU)^\\s*={1,6}\\s*(.+?)\\s*={1,6}\\s*$", "$1")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    for coded, plain in REFERENCES:
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return strip(F.regexp_replace(F.regexp_replace(out, "[ \\t]+", " "), "\\n{3,}", "\n\n"))


def sections(text: Column) -> Column:
    """The sections of a page: (title, level, text), their markup kept. What stands before the first heading has no title and level 2; a page without headings is one section."""
    bodies = F.split(text, HEADING)
    heads = lambda group: F.regexp_extract_all(text, F.lit(HEADING), F.lit(group))
    shown = F.transform(heads(2), lambda t: F.regexp_replace(t, SHOWN_LINK, "$1"))
    rows = F.transform(
        F.arrays_zip(shown.alias("title"), F.transform(heads(1), F.length).alias("level"), F.slice(bodies, 2, 1 << 30).alias("text")),
        lambda s: F.struct(s["title"].alias("title"), s["level"].cast("int").alias("level"), s["text"].alias("text")),
    )
    lead = F.struct(F.lit("").alias("title"), F.lit(2).alias("level"), F.get(bodies, F.lit(0)).alias("text"))
    return F.when((F.size(bodies) == 1) | (F.get(bodies, F.lit(0)) != ""), F.concat(F.array(lead), rows)).otherwise(rows)


def _starts(text: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | text.startswith(p)
    return out


def _contains(text: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return out


def wiki_lists(text: Column) -> Column:
    """(categories, links, n_links, files, qid, disambiguation) of wiki markup.

    Links to other wikis are left out, anchors too; of targets that differ by case alone
    the first stays, and of all the first 2000, while `n_links` counts them all. The qid
    is that of a link to the knowledge base, or else of its template.
    """
    targets = F.filter(F.transform(F.regexp_extract_all(text, F.lit(LINK), F.lit(1)), strip), lambda t: t != "")
    named = lambda prefixes: F.array_distinct(F.filter(F.transform(F.filter(targets, lambda t: _starts(t, prefixes)), lambda t: strip(F.substr(t, F.locate(":", t) + 1))), lambda t: t != ""))
    plain = F.filter(targets, lambda t: ~_starts(t, (*CATEGORY, *FILE, *OTHER_WIKIS)))
    plain = F.filter(F.transform(plain, lambda t: strip(F.substring_index(t, "#", 1))), lambda t: t != "")
    lower = F.transform(plain, lambda t: F.lower(t))
    links = F.transform(F.array_distinct(lower), lambda t: F.get(plain, (F.array_position(lower, t) - 1).cast("int")))
    linked, template = F.regexp_extract(text, QID_LINK, 1), F.regexp_extract(text, QID_TEMPLATE, 1)
    head = F.lower(F.substring(text, 1, TEXT_HEAD))
    return F.struct(
        named(CATEGORY).alias("categories"), F.slice(links, 1, MOST_LINKS).alias("links"), F.size(links).alias("n_links"), named(FILE).alias("files"),
        F.coalesce(F.nullif(linked, F.lit("")), F.nullif(template, F.lit(""))).alias("qid"),
        (_contains(head, DISAMBIGUATION) | _contains(F.substring(text, 1, TITLE_HEAD), DISAMBIGUATION_TITLE)).alias("disambiguation"),
    )


def markdown(title: Column, parts: Column) -> Column:
    """(markdown, n_passages) of a page: its title, then its sections (title, text) cleaned; those without text are left out."""
    cleaned = F.filter(F.transform(parts, lambda s: F.struct(s["title"].alias("title"), wikitext_clean(s["text"]).alias("text"))), lambda s: s["text"] != "")
    shown = F.transform(cleaned, lambda s: F.when(s["title"] != "", F.concat(F.lit("\n## "), s["title"], F.lit("\n\n"), s["text"])).otherwise(F.concat(F.lit("\n"), s["text"])))
    n = F.aggregate(F.transform(cleaned, lambda s: F.size(wiki_passages(s["text"]))), F.lit(0), lambda a, x: a + x)
    return F.struct(F.array_join(F.concat(F.array(F.concat(F.lit("# "), title, F.lit("\n"))), shown), "\n").alias("markdown"), n.alias("n_passages"))


#: Extensions of images, roles of image properties, and properties that are none.
IMAGES = (".jpg", ".jpeg", ".png", ".svg", ".tif", ".tiff", ".gif", ".webp")
NO_IMAGE = ("P51", "P443", "P989", "P10", "P4896", "P373")
ROLES = {
    "P18": "representative", "P41": "flag", "P94": "coat_of_arms", "P158": "seal", "P154": "logo", "P1621": "logo_detailed", "P8972": "logo_small", "P109": "signature",
    "P117": "chem_structure", "P2716": "collage", "P181": "range_map", "P242": "locator_map", "P1846": "distribution_map", "P1442": "grave", "P1801": "monument",
    "P3451": "night_view", "P5252": "winter_view", "P2910": "icon", "P4291": "panorama", "P8592": "aerial_view", "P14": "traffic_sign", "P207": "bathymetry_map",
    "P15": "route_map", "P935": "gallery",
}


def is_image(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, "(\\.[^./]+)$", 1)).isin(*IMAGES)


def image_role(prop: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])[prop], F.lit("other_image"))


def file_key(name: Column) -> Column:
    """A file name as galleries are joined by it: stripped, with spaces for underscores."""
    return F.replace(strip(name), F.lit("_"), F.lit(" "))


#: The line of a gallery with its caption, and what is taken out of captions.
GALLERY_LINE = "(?idU)(?:^|\\n)\\s*(?:File|Image|文件|檔案)\\s*:\\s*([^|\\n\\]]+?)\\s*(?:\\|\\s*(?:\\d+\\s*=\\s*)?([^\\n]*))?(?=\\n|$)"
CAPTION_LINK, CAPTION_MARKS = "\\[\\[([^|\\]]*\\|)?([^\\]]+)\\]\\]", "'{2,}|<[^>]+>|\\{\\{[^}]*\\}\\}"


def captions(text: Column) -> Column:
    """(file, caption) of the lines of a gallery, the first of each file; captions without markup."""
    found = lambda group: F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(GALLERY_LINE), F.lit(group))
    plain = lambda c: strip(F.regexp_replace(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), CAPTION_LINK, "$2"), CAPTION_MARKS, ""))
    rows = F.transform(F.arrays_zip(found(1).alias("f"), found(2).alias("c")), lambda x: F.struct(file_key(x["f"]).alias("file"), plain(x["c"]).alias("caption")))
    rows = F.filter(rows, lambda r: r["file"] != "")
    files = F.transform(rows, lambda r: r["file"])
    return F.filter(rows, lambda r, i: F.array_position(files, r["file"]) == i + 1)
