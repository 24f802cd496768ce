"""Search results: identity, merge, score, order; the query language; payload parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .relational import first_wins, free_name

#: Results that may join the first of a run, and results in later runs that close it.
GROUP, DISTANCE = 8, 20


def result_key(url: Column, template: Column, image: Column) -> Column:
    """What makes two results the same: everything of the address but its scheme; for images the image too."""
    bare = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.concat_ws("\u0001", template, bare, F.coalesce(image, F.lit("")))


def merge_results(results: DataFrame) -> DataFrame:
    """From (query, engine, position, url, title, content, template, img_src, weight) one row a query and result.

    The longest title and content win, ties to the first position; engines and positions
    are gathered; a scheme that ends in s is preferred. Bounded by the engines asked, so a
    group is small.
    """
    key = result_key(F.col("url"), F.col("template"), F.col("img_src"))
    longest = lambda c: F.max_by(c, F.struct(F.length(c), -F.col("position"), F.col("engine")))
    secure = F.regexp_extract("url", "^([A-Za-z]+)://", 1).endswith("s")
    return results.groupBy("query", key.alias("result_key")).agg(
        F.max_by("url", F.struct(secure, -F.col("position"), "engine")).alias("url"),
        longest(F.coalesce("title", F.lit(""))).alias("title"),
        longest(F.coalesce("content", F.lit(""))).alias("content"),
        F.array_sort(F.collect_set("engine")).alias("engines"),
        F.array_sort(F.collect_list("position")).alias("positions"),
        F.array_sort(F.collect_set(F.struct("engine", "weight"))).alias("_weights"),
        F.min("template").alias("template"),
        F.max("img_src").alias("img_src"),
        F.min_by("category", F.struct("position", "engine")).alias("category"),
    )


def with_score(merged: DataFrame, priority: Column | None = None) -> DataFrame:
    """Add `score`: the product of the engines' weights times the number of positions, over each position, summed; high priority ignores the place, low scores 0."""
    product = F.aggregate("_weights", F.lit(1.0), lambda a, w: a * w["weight"])
    weight = product * F.size("positions")
    each = lambda p: F.when(priority == "low", 0.0).when(priority == "high", weight).otherwise(weight / p) if priority is not None else weight / p
    return merged.withColumn("score", F.aggregate(F.transform("positions", each), F.lit(0.0), lambda a, x: a + x)).drop("_weights")


def placed(groups: Column) -> Column:
    """The final order of results that come by score, as their 0-based places in `groups`, the array of their groups.

    The order is a row of runs, each of one group. A result joins the last run of its group
    if that holds no more than GROUP results and fewer than DISTANCE stand in the runs behind it;
    otherwise it starts a run at the end.
    """
    start = F.array().cast("array<struct<g:string,items:array<int>>>")
    back = lambda runs, g: F.array_position(F.reverse(F.transform(runs, lambda r: r["g"])), g).cast("int")

    def step(runs: Column, x: Column) -> Column:
        last = F.size(runs) - back(runs, x["g"])
        behind = F.aggregate(F.slice(runs, last + 2, F.size(runs) + 1), F.lit(0), lambda n, r: n + F.size(r["items"]))
        joins = (back(runs, x["g"]) > 0) & (F.size(F.get(runs, last)["items"]) <= GROUP) & (behind < DISTANCE)
        longer = F.transform(runs, lambda r, i: F.struct(r["g"].alias("g"), F.when(i == last, F.array_append(r["items"], x["i"])).otherwise(r["items"]).alias("items")))
        return F.when(joins, longer).otherwise(F.array_append(runs, F.struct(x["g"].alias("g"), F.array(x["i"]).alias("items"))))

    numbered = F.transform(groups, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    return F.aggregate(numbered, start, step, lambda runs: F.flatten(F.transform(runs, lambda r: r["items"])))


def ordered_results(scored: DataFrame) -> DataFrame:
    """(query, result_key, url, title, score, place): by score, then in runs of one category, template and presence of an image.

    A query's results, some hundreds that the engines returned for it, are one array: the order builds on itself.
    """
    group = F.concat_ws(":", F.coalesce("category", F.lit("")), F.coalesce("template", F.lit("")), F.when(F.col("img_src").isNotNull(), "img_src").otherwise(""))
    row = F.struct((-F.col("score")).alias("by"), "result_key", "url", "title", "score", group.alias("group"))
    rows = scored.groupBy("query").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    order = rows.select("query", "rows", placed(F.transform("rows", lambda r: r["group"])).alias("order"))
    each = order.select("query", "rows", F.posexplode("order").alias("place", "at"))
    return each.select("query", F.get("rows", F.col("at")).alias("r"), F.col("place").cast("long").alias("place")).select("query", "r.result_key", "r.url", "r.title", "r.score", "place")


def merge_infoboxes(boxes: DataFrame) -> DataFrame:
    """From (query, box_id, engine, weight, position, content, img_src, urls, attributes) one row a box.

    The heaviest engine names it and gives the image; urls and attributes (label, value) are united, the first of each wins; the longest content stays.
    """
    order, box = F.struct(-F.col("weight"), "position"), ["query", "box_id"]
    merged = boxes.groupBy(*box).agg(
        F.min_by("engine", order).alias("engine"), F.min_by("img_src", order).alias("img_src"),
        F.max_by("content", F.struct(F.length(F.coalesce("content", F.lit(""))), -F.col("position"))).alias("content"),
    )
    # The first of each value is found by grouping before a box's values come together.
    for name, of in (("urls", F.col("item")), ("attributes", F.col("item.label"))):
        each = boxes.select(*box, F.struct("position", "urls", "attributes").alias("row"), F.posexplode(name).alias("at", "item")).withColumn("of", of)
        each = each if name == "urls" else each.where("of IS NOT NULL")
        firsts = each.groupBy(*box, "of").agg(F.min(F.struct("row", "at", "item")).alias("first"))
        united = firsts.groupBy(F.col("query").alias("_query"), F.col("box_id").alias("_box")).agg(F.transform(F.array_sort(F.collect_list("first")), lambda x: x["item"]).alias("_united"))
        same = F.col("query").eqNullSafe(F.col("_query")) & F.col("box_id").eqNullSafe(F.col("_box"))
        none = F.array().cast(boxes.schema[name].dataType)
        merged = merged.join(united, same, "left").withColumn(name, F.coalesce("_united", none)).drop("_query", "_box", "_united")
    return merged.select(*box, "engine", "img_src", "content", "urls", "attributes")


def parse_query(text: Column, bangs: tuple[str, ...], languages: tuple[str, ...]) -> Column:
    """(query, timeout, languages, bangs, external, lucky) of a search text.

    Tokens: `<N` a timeout (under 100 in seconds, else milliseconds), `:lang` a known
    language or a two- or three-letter code, `!!x` an external bang, a lone `!!` lucky, `!x` a
    known engine, category or shortcut. What no rule takes stays in the query.
    """
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), "\\s+"), lambda t: t != "")
    language = lambda t: F.replace(F.lower(F.substr(t, F.lit(2))), F.lit("_"), F.lit("-"))
    is_timeout = lambda t: t.rlike("^<\\d+$")
    is_language = lambda t: t.startswith(":") & (language(t).isin(*languages) | language(t).rlike("^[a-z]{2,3}(-[a-z]{2})?$|^auto$"))
    is_external = lambda t: t.rlike("^!!\\S+$")
    is_lucky = lambda t: t == "!!"
    is_bang = lambda t: t.startswith("!") & F.replace(F.lower(F.substr(t, F.lit(2))), F.lit("_"), F.lit(" ")).isin(*bangs)
    seconds = F.get(F.transform(F.filter(tokens, is_timeout), lambda t: F.substr(t, F.lit(2)).cast("double")), F.size(F.filter(tokens, is_timeout)) - 1)
    region = lambda c: F.when(c.contains("-"), F.concat(F.substring_index(c, "-", 1), F.lit("-"), F.upper(F.substring_index(c, "-", -1)))).otherwise(c)
    rest = F.filter(tokens, lambda t: ~(is_timeout(t) | is_language(t) | is_external(t) | is_lucky(t) | is_bang(t)))
    return F.struct(
        F.array_join(rest, " ").alias("query"), F.when(seconds < 100, seconds).otherwise(seconds / 1000).alias("timeout"),
        F.array_distinct(F.transform(F.filter(tokens, is_language), lambda t: region(language(t)))).alias("languages"),
        F.array_distinct(F.transform(F.filter(tokens, is_bang), lambda t: F.replace(F.lower(F.substr(t, F.lit(2))), F.lit("_"), F.lit(" ")))).alias("bangs"),
        F.get(F.transform(F.filter(tokens, is_external), lambda t: F.substr(t, F.lit(3))), F.lit(0)).alias("external"),
        F.exists(tokens, is_lucky).alias("lucky"),
    )


def timeout(engine: Column, user: Column, most: Column) -> Column:
    """The time a request may take: the user's wish or the engine's default, bounded by the maximum where there is one."""
    return F.when(user.isNull(), F.least(engine, most)).otherwise(F.least(user, most))


def image_candidates(payloads: DataFrame, k: int) -> DataFrame:
    """Candidate rows (query, position, tiers, width, height, landing, source) of aggregated image results.

    `payloads` has (query, pageno, payload JSON). Pages are united in order, the first row
    of an image address stays, tiers are the full image then the thumbnail, "W x H" gives
    the sides. Payloads that aren't JSON count as pages without results.
    """
    row = "img_src string, thumbnail_src string, url string, resolution string, engine string"
    parsed = payloads.select("query", "pageno", F.posexplode(F.from_json("payload", f"results array<struct<{row.replace(' string', ':string')}>>")["results"]).alias("at", "r"))
    best = F.coalesce(F.nullif("r.img_src", F.lit("")), F.nullif("r.thumbnail_src", F.lit("")))
    parsed = parsed.select("query", "pageno", "at", "r", best.alias("image")).where("image is not null")
    first = parsed.groupBy("query", "image").agg(F.min_by("r", F.struct("pageno", "at")).alias("r"), F.min(F.struct("pageno", "at")).alias("order"))
    from .relational import top_n_per_key

    side = lambda i: F.regexp_extract("r.resolution", "^\\s*(\\d+)\\s*[x×]\\s*(\\d+)\\s*$", i).try_cast("int")
    return top_n_per_key(first, ["query"], ["order"], k).select(
        "query", "order", F.filter(F.array(F.nullif("r.img_src", F.lit("")), F.nullif("r.thumbnail_src", F.lit(""))), lambda t: t.isNotNull()).alias("tiers"),
        side(1).alias("width"), side(2).alias("height"), F.col("r.url").alias("landing"), F.lower(F.replace("r.engine", F.lit(" "), F.lit("_"))).alias("source"),
    )


def text_candidates(payloads: DataFrame, k: int) -> DataFrame:
    """Page candidates of aggregated text results: the first k of each query, then one an address; snippets of 300 characters, authority wiki or serp."""
    row = "url:string,title:string,content:string,engine:string"
    parsed = payloads.select("query", F.posexplode(F.from_json("payload", f"results array<struct<{row}>>")["results"]).alias("at", "r")).where(F.col("at") < k)
    authority = F.when(F.lower("r.engine").contains("wiki"), "wiki").otherwise("serp")
    return parsed.groupBy("query", F.col("r.url").alias("page_url")).agg(F.min_by("r", "at").alias("r"), F.min("at").alias("at")).select(
        "query", "at", "page_url", F.col("r.title").alias("title"), F.substring("r.content", 1, 300).alias("snippet"), authority.alias("authority")
    )


def relevant(pages: DataFrame, concept: str, least: int = 18) -> DataFrame:
    """Pages (concept, url, position, score, …) fit to be read: of each address the first that a concept's searches returned, if its score is `least` or more; `place` orders them by score, then position."""
    once = first_wins(pages, [concept, "url"], ["position"]).where(F.col("score") >= least)
    return once.withColumn("place", F.row_number().over(Window.partitionBy(concept).orderBy(F.desc("score"), "position", "url")) - 1)


def source_slice(rows: DataFrame, seed: str, source: str, position: str, top: Column, fanout: Column | None = None) -> DataFrame:
    """The first rows of each seed and source, in the source's order: `top` (a hint of the seed or the default) times the source's `fanout`."""
    place = F.row_number().over(Window.partitionBy(seed, source).orderBy(position))
    most = top * (F.lit(1) if fanout is None else F.coalesce(fanout, F.lit(1)))
    at = free_name(rows, "place")
    return rows.withColumn(at, place).where(F.col(at) <= most).drop(at)


def routed(query: Column, bangs: Column) -> Column:
    """A search text led by its bangs, sorted, each once: `!a !b text`."""
    marks = F.transform(F.array_sort(F.array_distinct(F.coalesce(bangs, F.array().cast("array<string>")))), lambda b: F.concat(F.lit("!"), b))
    return F.concat_ws(" ", F.when(F.size(marks) > 0, F.array_join(marks, " ")), query)


def live_bangs(engines: Column, live: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, bangs): of each row's engines the bangs of those that are enabled, sorted, each once; `live` has (engine, bang)."""
    named = rows.select(key, F.explode_outer(engines).alias("engine")).join(live, "engine", "left")
    return named.groupBy(key).agg(F.array_sort(F.collect_set("bang")).alias("bangs"))


def answered_or_asked(queries: DataFrame, key: str, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers, queries still to be asked): a query that any answerer answers goes to no engine. `answers` has (key, answerer, answer), nulls for none."""
    given = answers.where(F.col("answer").isNotNull())
    return given, queries.join(given.select(key).distinct(), key, "left_anti")


def through_plugins(results: DataFrame, plugins: list[tuple[Column | None, dict[str, Column]]]) -> DataFrame:
    """Results that a chain of plugins lets pass, rewritten by it. A plugin has a condition to keep a result (null result: dropped; no condition: all) and new values of columns; the next plugin sees these."""
    for keep, changes in plugins:
        results = results if keep is None else results.where(F.coalesce(keep, F.lit(False)))
        results = results.withColumns(changes) if changes else results
    return results
