"""Payloads of single-site image searches, parsed to candidate rows.

An adapter turns one payload (JSON, HTML or RSS text) into an array of candidates in the
site's own order. `candidates` then drops repeats and cuts to k within the row: a payload
is one page of results, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import html_unescape, int_or_null

from .gates import image_urls

#: Most candidates of a semantic and of a structured source.
SEMANTIC, STRUCTURED = 5, 15
#: Patterns and addresses of the sites' formats.
MAL_ROW = r'(?s)(href="https://myanimelist\.net/character/\d+/[^"]+".*?data-src="[^"]+")'
BING_BLOCK = r'(?s)m="(\{.*?\})"\s'
YANDEX_ENTRY = r'(\{"url":"https://[^"]+","fileSizeInBytes":\d+,"w":\d+,"h":\d+\})'
RSS_ITEM = r"(?s)<item>(.*?)</item>"
MEDIA_CONTENT = r'<media:content\s+url="([^"]+)"[^>]*height="(\d+)"\s+width="(\d+)"'
IMAGE_LINK = r"(?i)(https?://[^\s\"'<>]+\.(?:jpg|jpeg|png|webp))"
HUABAN_HOST = "https://hbimg.huaban.com/"
TOUTIAO_HOSTS, TOUTIAO_BARRED = ("byteimg.com", "douyinpic.com"), ("toutiaoimg.com",)
#: Parts of addresses of decoration, not content.
DECORATION = (
    "icon", "logo", "avatar", "emoji", "banner", "ad", "btn", "sprite", "bg", "arrow", "nav", "footer", "header", "qrcode", "wechat", "badge",
    "loading", "placeholder", "default", "thumb_s", "-gray", "play", "ico", "pixel", "counter", "stat",
)


@dataclass(frozen=True)
class Adapter:
    """How a site's payload is read, its own cap, whether repeats go, and when the answer is no result but a failure."""

    parse: Callable[[Column], Column]
    cap: int
    once: bool = True
    failed: Callable[[Column], Column] = lambda payload: F.lit(None).cast("string")


def _candidate(tiers: Column, landing: Column | None = None, width: Column | None = None, height: Column | None = None, mime: Column | None = None,
               licence: Column | None = None, author: Column | None = None, native: dict[str, Column] | None = None) -> Column:
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    whole = lambda c: F.lit(None).cast("int") if c is None else int_or_null(c)
    site = F.to_json(F.struct(*[c.alias(n) for n, c in (native or {}).items()])) if native else F.lit("{}")
    return F.struct(
        tiers.alias("tiers"), text(landing).alias("landing"), whole(width).alias("width"), whole(height).alias("height"), text(mime).alias("mime"),
        text(licence).alias("license"), text(author).alias("author"), site.alias("native"),
    )


def _addresses(*urls: Column) -> Column:
    """Those of the urls that are addresses, in order, each once."""
    return F.array_distinct(F.filter(F.array(*[F.trim(u) for u in urls]), lambda u: F.coalesce(F.lower(u).startswith("http"), F.lit(False))))


def _not_json(payload: Column) -> Column:
    return F.when(F.try_parse_json(payload).isNull(), "transient")


def _commons(payload: Column) -> Column:
    value = "struct<value:string>"
    page = (
        "struct<index:string,title:string,pageid:long,pageprops:struct<canonicalurl:string>,imageinfo:array<struct<url:string,descriptionurl:string,width:int,height:int,"
        f"mime:string,mediatype:string,extmetadata:struct<LicenseShortName:{value},Artist:{value}>>>>"
    )
    pages = F.map_values(F.from_json(payload, f"query struct<pages:map<string,{page}>>")["query"]["pages"])
    ranked = F.array_sort(F.transform(pages, lambda p: F.struct(F.coalesce(int_or_null(p["index"]), F.lit(0)).alias("at"), p["pageid"].alias("id"), p.alias("p"))))

    def one(ranked_page: Column) -> Column:
        p = ranked_page["p"]
        info = F.get(p["imageinfo"], F.lit(0))
        return _candidate(
            F.array_compact(F.array(info["url"])), F.coalesce(p["pageprops"]["canonicalurl"], info["descriptionurl"]), info["width"], info["height"], info["mime"],
            info["extmetadata"]["LicenseShortName"]["value"], info["extmetadata"]["Artist"]["value"], {"page_title": p["title"], "page_id": p["pageid"], "mediatype": info["mediatype"]},
        )

    return F.transform(ranked, one)


def _baidu(payload: Column) -> Column:
    item = "struct<middleURL:string,thumbURL:string,hoverURL:string,fromURL:string,fromPageTitleEnc:string,width:string,height:string,di:string>"
    items = F.from_json(payload, f"data array<{item}>")["data"]

    def one(it: Column) -> Column:
        url = F.get(_addresses(it["middleURL"], it["thumbURL"], it["hoverURL"]), F.lit(0))
        w, h = F.regexp_extract(url, r"[?&]w=(\d+)", 1), F.regexp_extract(url, r"[?&]h=(\d+)", 1)
        both = (w != "") & (h != "")
        native = {"from_page_title": it["fromPageTitleEnc"], "from_url": it["fromURL"], "orig_width": int_or_null(it["width"]), "orig_height": int_or_null(it["height"]), "size_bytes": int_or_null(it["di"])}
        return _candidate(F.array_compact(F.array(url)), F.coalesce(F.nullif(it["fromURL"], F.lit("")), it["hoverURL"]), F.when(both, w), F.when(both, h), native=native)

    return F.transform(items, one)


def _baidu_failed(payload: Column) -> Column:
    flag = F.get_json_object(payload, "$.antiFlag")
    return F.coalesce(_not_json(payload), F.when(flag.isNotNull() & ~flag.isin("0", "false", "", "null"), "deterministic"))


def _anilist(payload: Column) -> Column:
    char = F.from_json(payload, "data struct<Character:struct<id:long,name:struct<full:string>,image:struct<large:string>,siteUrl:string>>")["data"]["Character"]
    return F.array(_candidate(F.array_compact(F.array(F.nullif(char["image"]["large"], F.lit("")))), char["siteUrl"], native={"character_id": char["id"], "character_name": char["name"]["full"]}))


def _mal(payload: Column) -> Column:
    def one(row: Column) -> Column:
        number, name = F.regexp_extract(row, r"/character/(\d+)/", 1), F.regexp_extract(row, r'/character/\d+/([^"]+)"', 1)
        image = F.regexp_replace(F.regexp_extract(row, r'data-src="([^"]+)"$', 1), r"^(.*?)/r/\d+x\d+/", "$1/")
        landing = F.concat(F.lit("https://myanimelist.net/character/"), number, F.lit("/"), name)
        return _candidate(F.array(image), landing, native={"character_id": number.cast("long"), "character_name": F.replace(name, F.lit("_"), F.lit(" "))})

    return F.transform(F.regexp_extract_all(payload, F.lit(MAL_ROW), F.lit(1)), one)


def _pixiv(payload: Column) -> Column:
    art = "struct<id:string,title:string,url:string,illustType:string,xRestrict:int,userName:string,userId:string,width:string,height:string>"
    arts = F.from_json(payload, f"body struct<illustManga:struct<data:array<{art}>>>")["body"]["illustManga"]["data"]

    def one(a: Column) -> Column:
        master = F.regexp_replace(F.replace(a["url"], F.lit("/c/250x250_80_a2/"), F.lit("/")), r"_square1200(\.\w+)$", "_master1200$1")
        stem = F.regexp_replace(F.replace(master, F.lit("/img-master/"), F.lit("/img-original/")), r"_master1200\.\w+$", "")
        only_master = F.coalesce(int_or_null(a["illustType"]) == 2, F.lit(False)) | master.contains("/custom-thumb/")
        tiers = F.when(only_master, F.array(master)).otherwise(F.array(F.concat(stem, F.lit(".jpg")), F.concat(stem, F.lit(".png")), master))
        native = {"artwork_id": a["id"], "title": a["title"], "illust_type": int_or_null(a["illustType"]), "user_id": a["userId"]}
        return _candidate(tiers, F.concat(F.lit("https://www.pixiv.net/artworks/"), a["id"]), a["width"], a["height"], author=a["userName"], native=native)

    open_to_all = F.filter(arts, lambda a: (F.coalesce(a["xRestrict"], F.lit(0)) <= 0) & (F.coalesce(a["url"], F.lit("")) != ""))
    return F.transform(open_to_all, one)


def _bing(payload: Column) -> Column:
    blocks = F.transform(
        F.regexp_extract_all(payload, F.lit(BING_BLOCK), F.lit(1)), lambda m: F.from_json(html_unescape(m), "murl string, purl string, mw string, mh string, t string, desc string")
    )
    return F.transform(blocks, lambda b: _candidate(_addresses(b["murl"]), b["purl"], b["mw"], b["mh"], native={"title": b["t"], "desc": b["desc"]}))


def _yandex(payload: Column) -> Column:
    entries = F.transform(
        F.regexp_extract_all(html_unescape(payload), F.lit(YANDEX_ENTRY), F.lit(1)), lambda e: F.from_json(e, "url string, fileSizeInBytes long, w int, h int")
    )
    return F.transform(entries, lambda e: _candidate(F.array(e["url"]), None, e["w"], e["h"], native={"file_size": e["fileSizeInBytes"]}))


def _deviantart(payload: Column) -> Column:
    def one(item: Column) -> Column:
        found = lambda i: F.nullif(F.regexp_extract(item, MEDIA_CONTENT, i), F.lit(""))
        tag = lambda name: F.when(item.rlike(f"<{name}[^>]*>"), F.trim(html_unescape(F.regexp_extract(item, f"(?s)<{name}[^>]*>(.*?)</{name}>", 1))))
        return _candidate(F.array_compact(F.array(found(1))), tag("link"), found(3), found(2), author=tag("media:credit"), native={"title": tag("title")})

    return F.transform(F.regexp_extract_all(payload, F.lit(RSS_ITEM), F.lit(1)), one)


def _huaban(payload: Column) -> Column:
    pin = "struct<pin_id:long,file:struct<key:string,width:string,height:string>,board:struct<title:string>>"
    got = F.from_json(payload, f"pins array<{pin}>, data array<{pin}>")
    pins = F.when(F.size(F.coalesce(got["pins"], F.array().cast(f"array<{pin}>"))) > 0, got["pins"]).otherwise(got["data"])
    url = lambda p: F.when(p["file"]["key"] != "", F.concat(F.lit(HUABAN_HOST), p["file"]["key"]))
    native = lambda p: {"pin_id": p["pin_id"], "board_title": p["board"]["title"]}
    return F.transform(pins, lambda p: _candidate(F.array_compact(F.array(url(p))), None, p["file"]["width"], p["file"]["height"], native=native(p)))


def _toutiao(payload: Column) -> Column:
    links = F.regexp_extract_all(payload, F.lit(IMAGE_LINK), F.lit(1))
    kept = image_urls(links, TOUTIAO_HOSTS, ("jpg", "jpeg", "png", "webp"), (*TOUTIAO_BARRED, *DECORATION))
    return F.transform(kept, lambda u: _candidate(F.array(u)))


def _so360(payload: Column) -> Column:
    item = "struct<imgurl:string,middle:string,thumb:string,url:string,width:string,height:string,title:string>"
    items = F.from_json(payload, f"list array<{item}>")["list"]
    # A tier goes to the first item that has it.
    tiers = F.transform(items, lambda it: _addresses(it["imgurl"], it["middle"], it["thumb"]))
    earlier = lambda i: F.flatten(F.slice(tiers, F.lit(1), i))
    return F.transform(
        items, lambda it, i: _candidate(F.array_except(F.get(tiers, i), earlier(i)), F.nullif(it["url"], F.lit("")), it["width"], it["height"], native={"title": it["title"]})
    )


ADAPTERS = {
    "wikimedia_zh": Adapter(_commons, SEMANTIC, once=False),
    "wikimedia": Adapter(_commons, SEMANTIC, once=False),
    "baidu": Adapter(_baidu, SEMANTIC, failed=_baidu_failed),
    "anilist": Adapter(_anilist, STRUCTURED),
    "mal": Adapter(_mal, SEMANTIC),
    "pixiv": Adapter(_pixiv, STRUCTURED, once=False, failed=lambda p: F.when(F.get_json_object(p, "$.error") == "true", "transient")),
    "bing_images": Adapter(_bing, SEMANTIC),
    "yandex_images": Adapter(_yandex, SEMANTIC),
    "deviantart": Adapter(_deviantart, STRUCTURED),
    "huaban_api": Adapter(_huaban, SEMANTIC, failed=_not_json),
    "toutiao": Adapter(_toutiao, SEMANTIC),
    "so360": Adapter(_so360, SEMANTIC, failed=_not_json),
}


def failures(payloads: DataFrame, source: str = "source", payload: str = "payload") -> DataFrame:
    """Add `failure`: transient (try again), deterministic (don't) or null, by the rules of each row's site."""
    kind = F.lit(None).cast("string")
    for name, adapter in ADAPTERS.items():
        kind = F.when(F.col(source) == name, adapter.failed(F.col(payload))).otherwise(kind)
    return payloads.withColumn("failure", kind)


def _first_of_each(rows: Column) -> Column:
    """Candidates with an address; of those with the same best tier the first."""
    rows = F.filter(rows, lambda c: F.size(c["tiers"]) > 0)
    best = F.transform(rows, lambda c: c["tiers"][0])
    return F.filter(rows, lambda c, i: F.array_position(best, c["tiers"][0]) == i + 1)


def candidates(payloads: DataFrame, k: int, source: str = "source", payload: str = "payload") -> DataFrame:
    """One row a candidate: the other columns of `payloads`, `position`, and what the site tells of it.

    Rows of sites without an adapter, failed and null payloads give none. Candidates
    without an address go; of equal addresses the first stays; at most min(k, the site's cap) a payload.
    """
    found = F.lit(None).cast("array<struct<tiers:array<string>,landing:string,width:int,height:int,mime:string,license:string,author:string,native:string>>")
    for name, adapter in ADAPTERS.items():
        rows = adapter.parse(F.col(payload))
        if adapter.once:
            rows = _first_of_each(rows)
        rows = F.when(adapter.failed(F.col(payload)).isNull(), F.slice(rows, 1, min(k, adapter.cap)))
        found = F.when(F.col(source) == name, rows).otherwise(found)
    rest = [c for c in payloads.columns if c != payload]
    return payloads.select(*rest, F.posexplode(found).alias("position", "_c")).select(*rest, "position", "_c.*")
