"""String, URL, hash and array functions, all in built-in expressions."""

from __future__ import annotations

import json
import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, f) -> Column:
    """f(value), with the value computed once however often f names it: as the variable of a lambda over one element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: A list with so many distinct values at most is told value by value; each element then looks among these.
FEW = 24


def told_once(found: Column, told) -> Column:
    """told(x) of each element of a list of strings without nulls, computed once for each distinct one where these are few."""

    def by_value(values: Column, distinct: Column) -> Column:
        known = F.map_from_arrays(distinct, F.transform(distinct, told))
        looked_up = bound(known, lambda m: F.transform(values, lambda x: m[x]))
        return F.when(F.size(distinct) <= FEW, looked_up).otherwise(F.transform(values, told))

    return bound(found, lambda values: bound(F.array_distinct(values), lambda distinct: by_value(values, distinct)))


def lang_tag(text: Column) -> Column:
    """zh if any character is in U+4E00 to U+9FFF, else latin."""
    return F.when(text.rlike("[\\u4e00-\\u9fff]"), "zh").otherwise("latin")


def quota_hint(least_images: Column) -> Column:
    """The result count to ask for: least_images * 1.6 / 56 rounded up, at least 1, in integers."""
    return F.greatest(F.lit(1), F.floor((least_images * 8 + 279) / 280).cast("int"))


def quality_score(kb: Column, focus: Column, richness: Column) -> Column:
    return F.round(0.4 * kb + 0.4 * focus + 0.2 * richness, 1)


def latin_aliases(aliases: Column, most: int = 8) -> Column:
    """Aliases with a Latin letter, the first of each spelling that differs by more than case."""
    latin = F.filter(F.transform(aliases, lambda a: F.trim(a)), lambda a: a.rlike("[A-Za-z]"))
    seen = F.transform(latin, lambda a: F.lower(a))
    return F.slice(F.filter(latin, lambda a, i: F.array_position(seen, F.lower(a)) == i + 1), 1, most)


def netloc(url: Column) -> Column:
    """User, host and port of an address; parse_url's HOST would lose user and port."""
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def local_path(path: str) -> str:
    """The path of a folder that every machine mounts, without the scheme that Spark is given."""
    return re.sub("^file:/*(?=/)", "", path)


def title_key(title: Column) -> Column:
    return F.replace(F.lower(F.trim(title)), F.lit("_"), F.lit(" "))


def file_name(value: Column) -> Column:
    """The file name in a link: blanks, angle brackets, `Special:FilePath/` and `File:` stripped, percent codes decoded, `+` kept."""
    name = F.regexp_replace(F.trim(value), "^<|>$", "")
    name = F.regexp_replace(name, "^.*Special:FilePath/", "")
    name = F.regexp_replace(name, "^File:", "")
    return F.trim(F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name))


def percent_encoded(text: Column) -> Column:
    """UTF-8 percent codes for all but letters and digits of ASCII and `_.-~`; the form that Spark has leaves `*`, codes `~` and writes a blank as `+`."""
    out = F.url_encode(text)
    for java, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(java), F.lit(plain))
    return out


def page_url(lang: Column, title: Column) -> Column:
    """The address of an encyclopedia page; spaces are underscores, slashes stay."""
    quoted = F.replace(percent_encoded(F.replace(title, F.lit(" "), F.lit("_"))), F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit("https://"), lang, F.lit(".wikipedia.org/wiki/"), quoted)


def triple_value(value: Column) -> Column:
    """An entity's identifier, or a literal without its quotes and escapes."""
    entity = F.regexp_extract(value, "/entity/(Q\\d+)>$", 1)
    literal = F.regexp_extract(value, '^"(.*)"(?:@[A-Za-z-]+|\\^\\^.*)?$', 1)
    for coded, plain in (('\\"', '"'), ("\\n", "\n"), ("\\\\", "\\")):
        literal = F.replace(literal, F.lit(coded), F.lit(plain))
    return F.when(entity != "", entity).when(value.startswith('"'), literal).otherwise(F.regexp_replace(value, "^<|>$", ""))


def upload_path(name: Column) -> Column:
    """m/md/name: the first digits of the name's MD5 as folders."""
    under = F.replace(name, F.lit(" "), F.lit("_"))
    digest = F.md5(under.cast("binary"))
    return F.concat_ws("/", F.substring(digest, 1, 1), F.substring(digest, 1, 2), percent_encoded(under))


def safe_extension(name: Column) -> Column:
    ext = F.lower(F.regexp_extract(name, "\\.([A-Za-z0-9]{1,5})$", 1))
    return F.when(ext != "", ext).otherwise("bin")


#: Leading bytes of file formats.
SIGNATURES = (("FFD8FF", "jpeg"), ("89504E47", "png"), ("47494638", "gif"), ("49492A00", "tiff"), ("4D4D002A", "tiff"), ("25504446", "pdf"), ("41542654464F524D", "djvu"))


def magic_class(body: Column) -> Column:
    """The class of a binary body by its first 2048 bytes.

    A format; webp; html with an error code, else its title (40 characters), else `?`, in
    brackets; svg; xml; html() for other markup; empty; or hex: with the first 8 bytes.
    """
    head = F.substring(body, 1, 2048)
    first = F.hex(F.substring(body, 1, 16))
    whole = F.decode(head, "ISO-8859-1")
    text = F.lower(F.substring(F.regexp_replace(whole, "^[ \\t\\n\\x0B\\f\\r]+", ""), 1, 24))
    code = F.regexp_extract(whole, "(?d)Error:\\s*(\\d{3})", 1)
    title = F.regexp_extract(whole, "<title>([^<]{0,80})</title>", 1)
    title = F.substring(F.trim(F.decode(F.encode(title, "ISO-8859-1"), "UTF-8")), 1, 40)
    told = F.when(code != "", code).when(whole.rlike("<title>[^<]{0,80}</title>"), title).otherwise("?")
    out = F.when(F.coalesce(F.length(body), F.lit(0)) == 0, "empty")
    for signature, name in SIGNATURES:
        out = out.when(first.startswith(signature), name)
    out = out.when(first.startswith("52494646") & (F.substring(first, 17, 8) == "57454250"), "webp")
    out = out.when(text.startswith("<!doctype") | text.startswith("<html"), F.concat(F.lit("html("), told, F.lit(")")))
    out = out.when(text.startswith("<svg"), "svg").when(text.startswith("<?xml"), "xml").when(first.startswith("3C"), "html()")
    return out.otherwise(F.concat(F.lit("hex:"), F.lower(F.substring(first, 1, 16))))


def resolution(text: Column) -> Column:
    """(width, height) of "W x H"; null parts where it isn't one."""
    part = lambda i: F.regexp_extract(text, "^\\s*(\\d+)\\s*[x×]\\s*(\\d+)\\s*$", i).try_cast("int")
    return F.struct(part(1).alias("width"), part(2).alias("height"))


def int_or_null(value: Column) -> Column:
    return F.trim(value.cast("string")).try_cast("int")


def source_name(name: Column, aliases: dict[str, str]) -> Column:
    key = F.replace(F.lower(F.trim(name)), F.lit(" "), F.lit("_"))
    if not aliases:
        return key
    return F.coalesce(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])[key], key)


def day_utc(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "MM-dd")


def strip_trackers(url: Column) -> Column:
    """An address without utm_*, ref, fbclid and gclid parameters, and without a question mark that ends it."""
    out = F.regexp_replace(url, "([?&])(?:(?:utm_[^=&#]*|ref|fbclid|gclid)=[^&#]*&?)+", "$1")
    return F.regexp_replace(out, "[?&](#|$)", "$1")


#: What may stand behind a DOI in an address, taken off in this order.
DOI_ENDS = ("/", ".pdf", ".xml", "/full", "/meta", "/abstract")


def doi(url: Column) -> Column:
    """The DOI in the path of an address, or else in one of its parameters, if under 50 characters; of the ends that name a file or view each is taken off in turn."""
    bare = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|#.*$", "")
    path, query = F.regexp_extract(bare, "^([^?]*)", 1), F.regexp_extract(bare, "\\?(.*)$", 1)
    values = F.transform(F.split(query, "&"), lambda p: F.coalesce(F.try_url_decode(F.substr(p, F.locate("=", p) + 1)), p))
    named = lambda t: F.regexp_extract(t, "(10\\.\\d{4,9}/\\S+)", 1)
    found = F.get(F.filter(F.transform(F.concat(F.array(path), values), named), lambda d: d != ""), F.lit(0))
    less = lambda d, end: F.when(F.endswith(d, end), F.substr(d, F.lit(1), F.length(d) - F.length(end))).otherwise(d)
    return F.aggregate(F.array(*map(F.lit, DOI_ENDS)), F.when(F.length(found) < 50, found), less)


def prettify(url: Column, most: int = 74) -> Column:
    half = most // 2 - 2
    return F.when(F.length(url) > most, F.concat(F.substring(url, 1, half), F.lit("[...]"), F.right(url, F.lit(half)))).otherwise(url)


#: Scripts whose words are marked wherever they stand.
UNSPACED = "[\u4e00-\u9fff\u3040-\u30ff\uac00-\ud7af\u1100-\u11ff]"


def highlight(text: Column, query: Column) -> Column:
    """The text with every occurrence of the query's words, in any case, in a span of the class highlight; texts with markup stay as they are.

    Words are cut at white space and stand without quote marks. One in Chinese, Japanese or Korean characters is marked wherever it is, any
    other where it stands as a word. Characters with a meaning in patterns stand for themselves.
    """
    words = F.transform(F.split(query, "\\s+"), lambda w: F.translate(w, "'\"", ""))
    plain = lambda w: F.regexp_replace(w, "([^\\p{L}\\p{N}_])", r"\\$1")
    bounded = lambda w: F.when(w.rlike(UNSPACED), plain(w)).otherwise(F.concat(F.lit("\\b"), plain(w), F.lit("(?!\\w)")))
    listed = F.transform(F.filter(words, lambda w: w != ""), bounded)
    marked = F.regexp_replace(text, F.concat(F.lit("(?iU)("), F.array_join(listed, "|"), F.lit(")")), F.lit('<span class="highlight">$1</span>'))
    return F.when(text.contains("<") | (F.coalesce(F.size(listed), F.lit(0)) <= 0), text).otherwise(marked)


def squeeze(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "\\s+", " "), "^\\s+|\\s+$", "")


def _references() -> dict[str, str]:
    """What the named references of HTML 4 and the numbers of the C1 range, read as Windows-1252, stand for."""
    named = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}
    for code in range(0x80, 0xA0):
        told = bytes([code]).decode("cp1252", "replace")
        named[f"#{code}"] = chr(code) if told == "\ufffd" else told
    return named


#: A character reference: by number, decimal or hexadecimal, or by name.
REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def html_unescape(text: Column) -> Column:
    """Text with the character references of markup decoded, each once: by number in any range, by the names of HTML 4. Unknown names stay; numbers of no character give U+FFFD."""
    known = F.from_json(F.lit(json.dumps(_references())), "map<string,string>")
    number = lambda r: F.when(r.rlike("^&#[xX]"), F.conv(F.substring(r, 4, 6), 16, 10)).otherwise(F.regexp_extract(r, "^&#([0-9]+)", 1)).try_cast("int")

    def character(r: Column) -> Column:
        code = number(F.replace(r, F.lit(";"), F.lit("")))
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        told = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(r.startswith("&#"), F.coalesce(known[F.concat(F.lit("#"), code.cast("string"))], told)).otherwise(F.coalesce(known[r], r))

    def decoded(t: Column) -> Column:
        told = told_once(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)), character)
        joined = F.array_join(F.zip_with(F.split(t, REFERENCE, -1), told, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
        return F.when(t.contains("&"), joined).otherwise(t)

    return bound(text, decoded)


def human_bytes(size: Column) -> Column:
    """A size in the largest unit it exceeds one of, on base 1024, with two digits: 1536 is 1.50 KB."""
    out = F.concat(F.format_string("%.2f", size.cast("double")), F.lit(" B "))
    for power, unit in enumerate(("KB", "MB", "GB", "TB"), start=1):
        out = F.when(size > 1024**power, F.concat(F.format_string("%.2f", F.bround(size / float(1024**power), 2)), F.lit(f" {unit}"))).otherwise(out)
    return out


def seconds_of(clock: Column) -> Column:
    """Seconds of mm:ss or hh:mm:ss; null where it is neither."""
    parts = F.split(F.trim(clock), ":")
    total = F.aggregate(F.transform(parts, lambda p: p.try_cast("long")), F.lit(0).cast("long"), lambda a, p: a * 60 + p)
    return F.when(F.trim(clock).rlike("^\\d+(:\\d+){1,2}$"), total)


def clock_of(seconds: Column) -> Column:
    """mm:ss, or hh:mm:ss from an hour on (days fall away)."""
    part = lambda whole: F.lpad(F.floor(whole).cast("string"), 2, "0")
    hours, rest = F.pmod(F.floor(seconds / 3600), F.lit(24)), F.concat(part(F.pmod(F.floor(seconds / 60), F.lit(60))), F.lit(":"), part(F.pmod(seconds, F.lit(60))))
    return F.when(hours > 0, F.concat(part(hours), F.lit(":"), rest)).otherwise(rest)


def html_to_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags out, block tags as blank lines, character references decoded, no-break spaces as blanks."""
    out = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->", "")
    out = F.regexp_replace(out, "(?i)</?(p|div|br|li|ul|ol|h[1-6]|article|section|nav|table|tr|header|footer)\\b[^>]*>", "\n\n")
    out = F.regexp_replace(out, "<[^>]*>", "")
    return html_unescape(F.replace(out, F.lit("&nbsp;"), F.lit(" ")))


def annotation(reply: Column) -> Column:
    """The parsed annotation in a model's reply, or null: the first flat object with kb_match, scores clamped to 0..10, a boolean identity, a caption of 40 characters."""
    raw = F.regexp_extract(reply, '(?s)(\\{[^{}]*"kb_match"[^{}]*\\})', 1)
    got = F.from_json(raw, "kb_match string, richness string, focus string, identity string, caption string")
    score = lambda c: F.least(F.lit(10), F.greatest(F.lit(0), got[c].try_cast("int")))
    flat = F.regexp_extract(raw, '"identity"\\s*:\\s*(true|false)', 1)
    ok = score("kb_match").isNotNull() & score("richness").isNotNull() & score("focus").isNotNull() & (flat != "") & (F.length(got["caption"]) >= 40)
    out = F.struct(
        score("kb_match").alias("kb"), score("richness").alias("richness"), score("focus").alias("focus"), (flat == "true").alias("identity"), got["caption"].alias("caption"),
        quality_score(score("kb_match"), score("focus"), score("richness")).alias("quality"),
    )
    return F.when(ok, out)


#: The labels of a knowledge block and what it says without a description.
ENTITY, ALIASES, KNOWN, UNKNOWN = "实体：", "别名：", "知识：", "知识：（暂无，仅凭实体名称判断）"


def knowledge_block(name: Column, aliases: Column, description: Column) -> Column:
    """What a judge is told of an entity: its name, the first five aliases, and its description cut at 250 characters, each on a labelled line."""
    known = F.filter(F.transform(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: F.trim(a)), lambda a: a != "")
    said = F.trim(F.coalesce(description, F.lit("")))
    cut = F.when(F.length(said) > 250, F.concat(F.substring(said, 1, 250), F.lit("…"))).otherwise(said)
    return F.concat_ws(
        "\n", F.concat(F.lit(ENTITY), name), F.when(F.size(known) > 0, F.concat(F.lit(ALIASES), F.array_join(F.slice(known, 1, 5), "、"))),
        F.when(cut != "", F.concat(F.lit(KNOWN), cut)).otherwise(F.lit(UNKNOWN)),
    )


#: Parts of the addresses of trusted and of commercial sites, and marks of disambiguation pages.
TRUSTED = ("wikipedia.org", "baike.baidu.com", "zhihu.com", "britannica.com")
COMMERCE = ("amazon.", "ebay.", "taobao.", "jd.com", "tmall.", "alibaba.", "walmart.", "aliexpress.", "bolt.eu")
DISAMBIGUATION = ("可以指", "可以是指", "消歧义", "disambiguation")


def any_within(text: Column, parts: tuple[str, ...]) -> Column:
    return F.coalesce(F.greatest(F.lit(False), *[text.contains(p) for p in parts]), F.lit(False))


#: The edge of a word of letters, digits and underscores of any script; the `\b` of some Java versions knows ASCII alone.
EDGE = r"(?:(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_])|(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_]))"


def relevance(name: Column, aliases: Column, title: Column, url: Column, snippet: Column) -> Column:
    """How well a page fits a concept.

    100 for the name as title, 70 for the name within it; else the first alias that fits
    counts: 45 for a Latin alias under 5 characters that stands as a word in a title whose
    head has two words at most, 55 for any other alias within the title, both whatever the
    case. 6 for each word of three letters or more shared with name and aliases, 8 for a
    trusted site, less 40 each for commerce and for disambiguation pages.
    """
    t = F.trim(F.coalesce(title, F.lit("")))
    known = F.filter(F.transform(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: F.trim(a)), lambda a: a != "")
    short = lambda a: a.rlike("^[A-Za-z0-9 .-]+$") & (F.length(F.replace(a, F.lit(" "), F.lit(""))) < 5)
    word = lambda a: F.regexp_like(t, F.concat(F.lit(f"(?iu){EDGE}\\Q"), a, F.lit(f"\\E{EDGE}"))) & (F.size(F.split(F.trim(F.substring_index(t, "|", 1)), "\\s+")) <= 2)
    points = F.transform(known, lambda a: F.when(short(a), F.when(word(a), 45).otherwise(0)).when(F.lower(t).contains(F.lower(a)), 55).otherwise(0))
    alias = F.coalesce(F.get(F.filter(points, lambda x: x > 0), F.lit(0)), F.lit(0))
    base = F.when(t == name, 100).when(t.contains(name), 70).otherwise(alias)
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z]{3,})"), F.lit(1)))
    shared = 6 * F.size(F.array_intersect(tokens(t), tokens(F.concat_ws(" ", name, F.array_join(known, " ")))))
    extra = F.when(any_within(url, TRUSTED), 8).otherwise(0) - F.when(any_within(url, COMMERCE), 40).otherwise(0)
    unclear = any_within(snippet, DISAMBIGUATION) | t.contains("消歧义")
    return (base + shared + extra - F.when(unclear, 40).otherwise(0)).cast("int")


def drop_tags(value: Column) -> Column:
    """A text without tags, stripped."""
    return F.trim(F.regexp_replace(value, "<[^>]+>", ""))


#: Image formats by extension, where the name is not the extension in capitals.
FORMATS = {"jpg": "JPG", "jpeg": "JPG", "jpe": "JPG", "svg": "SVG", "tif": "TIF", "tiff": "TIF", "ico": "ICO", "png": "PNG", "gif": "GIF", "bmp": "BMP", "webp": "WEBP", "avif": "AVIF"}


def image_format(url: Column) -> Column:
    """The format that the path of an image's address shows; null where it shows none."""
    path = F.regexp_replace(url, "[?#].*$", "")
    return F.create_map(*[F.lit(x) for kv in FORMATS.items() for x in kv])[F.lower(F.regexp_extract(path, "\\.([A-Za-z0-9]+)$", 1))]


def result_content(title: Column, content: Column) -> Column:
    """A result's text with single spaces; none if it says what the title says."""
    plain = squeeze(F.coalesce(content, F.lit("")))
    return F.when(plain == squeeze(F.coalesce(title, F.lit(""))), "").otherwise(plain)


def clean_url(url: Column, rules: list[tuple[str, list[str], list[str]]]) -> Column:
    """An address without the parameters that rules (address pattern, exceptions, parameter patterns) name.

    Patterns hold from the start. A rule applies where its pattern fits and none of its exceptions; it then
    drops blank parameters too and writes the rest anew. Rules come one after the other, each on what the last left.
    """
    kinds = "array<struct<fits:string,spares:array<string>,drops:array<string>>>"
    begins = lambda p: f"^(?:{p})"
    listed = F.from_json(F.lit(json.dumps([{"fits": begins(a), "spares": [*map(begins, b)], "drops": [*map(begins, c)]} for a, b, c in rules])), kinds)
    again = lambda t: F.replace(percent_encoded(F.coalesce(F.try_url_decode(t), t)), F.lit("%20"), F.lit("+"))
    name = lambda p: F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), p)
    value = lambda p: F.substr(p, F.locate("=", p) + 1)

    def step(u: Column, r: Column) -> Column:
        query = F.regexp_extract(u, "\\?([^#]*)", 1)
        pairs = F.filter(F.split(query, "&"), lambda p: p.contains("=") & ~p.endswith("="))
        rest = F.filter(pairs, lambda p: ~F.exists(r["drops"], lambda d: F.regexp_like(name(p), d)))
        text = F.array_join(F.transform(rest, lambda p: F.concat(again(F.substring_index(p, "=", 1)), F.lit("="), again(value(p)))), "&")
        ends = F.regexp_extract(u, "(#.*)$", 1)
        anew = F.concat(F.regexp_extract(u, "^([^?#]*)", 1), F.when(text != "", F.concat(F.lit("?"), text)).otherwise(""), ends)
        applies = (F.size(pairs) > 0) & F.regexp_like(u, r["fits"]) & ~F.exists(r["spares"], lambda e: F.regexp_like(u, e))
        return F.when(applies, anew).otherwise(u)

    return F.aggregate(listed, url, step)
