"""Gates, filters and state rules as boolean or string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .relational import free_name


def quality_gate(quality: Column, identity: Column | None, least: float | None) -> Column:
    """quality >= least (missing fails) and identity is true (missing fails); a part that is off passes all."""
    ok = F.lit(True) if least is None else F.coalesce(quality >= least, F.lit(False))
    return ok if identity is None else ok & F.coalesce(identity, F.lit(False))


def shell_page_gate(passages: Column) -> Column:
    """Two passages or more, or one of 150 characters or more."""
    return (F.size(passages) >= 2) | ((F.size(passages) == 1) & (F.length(F.get(passages, F.lit(0))) >= 150))


def snippet_gate(snippet: Column) -> Column:
    return F.coalesce(F.length(snippet) >= 30, F.lit(False))


def wiki_gate(redirect: Column, disambiguation: Column, qid: Column, markdown: Column) -> Column:
    """No redirect, no disambiguation page, an identifier, and 400 bytes of text."""
    return redirect.isNull() & ~F.coalesce(disambiguation, F.lit(False)) & qid.isNotNull() & F.coalesce(F.octet_length(markdown) >= 400, F.lit(False))


def error_body(body: Column) -> Column:
    """Whether a binary body is empty or its first 15 bytes, stripped on the left and lower-cased, open an HTML document."""
    head = F.lower(F.regexp_replace(F.substring(body, 1, 15).cast("string"), "^\\s+", ""))
    return (F.coalesce(F.length(body), F.lit(0)) == 0) | head.startswith("<!doctype") | head.startswith("<html")


def least_side(width: Column, height: Column, least: int = 200) -> Column:
    return F.coalesce(F.least(width, height) >= least, F.lit(False)) & width.isNotNull() & height.isNotNull()


def self_consistent(page_sha: Column, url: Column) -> Column:
    return F.coalesce(page_sha == F.sha2(url.cast("binary"), 256), F.lit(False))


#: Fixed value: hours without any yield after which a source is put on probation.
PROBATION_HOURS = 72


def source_state(rows: Column, last_day: Column) -> Column:
    """alive if it yielded in the last day, cooldown if it ever did, else dead-candidate. `rows` counts all of its rows."""
    return F.when(last_day > 0, "alive").when(rows > 0, "cooldown").otherwise("dead-candidate")


def source_lives(enabled: DataFrame, yields: DataFrame, lives: DataFrame, now: Column) -> DataFrame:
    """The state of every enabled source (source, rows, w24, w1, state, dead_since, probation, due).

    `yields` has (source, rows, w24, w1), `lives` what the last run left: (source,
    dead_since, probation). A source without rows is dead since it was first seen so; after
    PROBATION_HOURS it is put on probation once, and `due` marks the run that does it. One
    that yields loses both.
    """
    joined = enabled.select("source").distinct().join(yields, "source", "left").join(lives.select("source", F.col("dead_since").alias("_dead"), F.col("probation").alias("_probation")), "source", "left")
    counts = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("rows", "w24", "w1")}
    t = joined.select("source", *[c.alias(n) for n, c in counts.items()], "_dead", "_probation").withColumn("state", source_state(F.col("rows"), F.col("w24")))
    dead = F.when(F.col("rows") == 0, F.coalesce("_dead", now))
    hours = (now.cast("timestamp").cast("double") - dead.cast("timestamp").cast("double")) / 3600
    due = F.coalesce((F.col("rows") == 0) & (hours >= PROBATION_HOURS) & F.col("_probation").isNull(), F.lit(False))
    probation = F.when(F.col("rows") == 0, F.when(due, now).otherwise(F.col("_probation")))
    return t.withColumns({"dead_since": dead, "probation": probation, "due": due}).drop("_dead", "_probation")


def publish_outcome(failed: Column, name_ok: Column, duplicate: Column, body: Column, content_ok: Column) -> Column:
    """fail, bad, dup, empty, bad or ok, in this order of tests."""
    empty = F.coalesce(F.length(F.trim(body)), F.lit(0)) == 0
    return F.when(failed, "fail").when(~name_ok, "bad").when(duplicate, "dup").when(empty, "empty").when(~F.coalesce(content_ok, F.lit(True)), "bad").otherwise("ok")


def backfill_outcome(exists: Column, transient: Column, error: Column, size: Column, cap: int, sha: Column, want: Column) -> Column:
    return (
        F.when(exists | transient, "skip").when(error.isNotNull(), F.concat(F.lit("net:"), error)).when(size > cap, "capped")
        .when(~sha.eqNullSafe(want), "sha_mismatch").otherwise("done")
    )


def host_rules(df: DataFrame, host: str, removed: list[str], replaced: list[tuple[str, str]], low: list[str], high: list[str]) -> DataFrame:
    """Drop rows whose host fits a removed pattern, rewrite hosts by the first pattern that fits, add `priority`; high overrides low."""
    for pattern in removed:
        df = df.where(~F.coalesce(F.col(host).rlike(pattern), F.lit(False)))
    renamed = F.col(host)
    for pattern, to in reversed(replaced):
        renamed = F.when(F.col(host).rlike(pattern), F.regexp_replace(host, pattern, to)).otherwise(renamed)
    any_of = lambda patterns: F.greatest(F.lit(False), F.lit(False), *[F.coalesce(F.col(host).rlike(p), F.lit(False)) for p in patterns])
    priority = F.when(any_of(high), "high").when(any_of(low), "low")
    return df.withColumn("priority", priority).withColumn(host, renamed)


def image_urls(urls: Column, hints: tuple[str, ...], extensions: tuple[str, ...], noise: tuple[str, ...]) -> Column:
    """Image addresses: those of a hinted host first, else in order; http made https, noise and other extensions out, repeats out."""
    secure = F.transform(urls, lambda u: F.regexp_replace(u, "(?i)^http://", "https://"))
    fits = F.filter(secure, lambda u: u.rlike("(?i)\\.(?:" + "|".join(extensions) + ")") & ~any_part(F.lower(u), noise))
    hinted = F.filter(fits, lambda u: any_part(F.lower(u), hints))
    others = F.filter(fits, lambda u: ~any_part(F.lower(u), hints))
    return F.array_distinct(F.concat(hinted, others))


def any_part(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether a text holds any of the parts; null text holds none."""
    return F.coalesce(F.greatest(F.lit(False), F.lit(False), *[text.contains(p) for p in parts]), F.lit(False))


def carried(carriers: Column, line: str) -> Column:
    """Whether a concept belongs to the image or the text line: all but those that name the other line alone; without a carrier it belongs to both."""
    other = {"image": "text", "text": "image"}[line]
    return F.coalesce(carriers != other, F.lit(True))


def has_sitelinks(entity: Column) -> Column:
    """Whether an entity's JSON tells of one site link or more and not that it is missing."""
    links = F.json_object_keys(F.get_json_object(entity, "$.sitelinks"))
    return (F.coalesce(F.size(links), F.lit(0)) > 0) & F.get_json_object(entity, "$.missing").isNull()


def deep_check(size: Column, extension: Column, extensions: tuple[str, ...], least: int = 6000) -> Column:
    """Whether a stored file is worth a look into its content: over `least` bytes and of a known extension."""
    return F.coalesce((size > least) & extension.isin(*extensions), F.lit(False))


def not_disambiguation(extract: Column) -> Column:
    """Whether an encyclopedia extract is an article: over 300 characters, and none of the marks of a list of meanings in its first 300."""
    head = F.substring(extract, 1, 300)
    marked = F.lit(False)
    for mark in MEANINGS:
        marked = marked | head.contains(mark)
    return F.coalesce((F.length(F.trim(extract)) > 300) & ~marked, F.lit(False))


#: Classes of a body that make its row poison.
POISON = ("html", "empty", "missing", "err")


def poisoned(ledger: DataFrame, sniffed: DataFrame, key: str) -> DataFrame:
    """The rows of a ledger whose body is poison, with `class` and `err` of what was sniffed (key, class, err): the others, and those that were not sniffed, stay out."""
    bad = sniffed.where(F.col("class").isin(*POISON)).select(F.col(key).alias("_key"), "class", "err")
    return ledger.join(bad, F.col(key) == F.col("_key")).drop("_key")


#: Marks of a list of meanings.
MEANINGS = ("may also refer to", "可以指", "可以是指")


def robots_rules(files: DataFrame, agent: str) -> DataFrame:
    """(origin, place, allow, pattern): the rules for an agent in robots files (origin, body), percent codes decoded.

    Agent lines in a row share the rules that follow them up to a blank line or the next agent line. The first
    group counts that names a part of the agent (what stands before a slash, in any case); else the first that names `*`; groups without
    rules count for nothing. Comments and unknown fields are passed over; a rule without a path allows all. A file
    that could not be read has a null body and gives no rules. A window holds the lines of one file.
    """
    lines = files.where("body IS NOT NULL").select("origin", F.posexplode(F.split("body", "\\r\\n|\\r|\\n")).alias("at", "line"))
    said = F.trim(F.regexp_replace("line", "#.*$", ""))
    field, value = F.lower(F.trim(F.substring_index(said, ":", 1))), F.trim(F.regexp_extract(said, "(?s)^[^:]*:(.*)$", 1))
    kind = F.when(F.trim("line") == "", "blank").when(~said.contains(":"), None).when(field == "user-agent", "agent").when(field.isin("allow", "disallow", "crawl-delay", "request-rate"), "rule")
    lines = lines.select("origin", "at", kind.alias("kind"), field.alias("field"), F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value).alias("value")).where("kind IS NOT NULL")
    order = Window.partitionBy("origin").orderBy("at")
    opens = (F.col("kind") == "agent") & ~F.lag("kind").over(order).eqNullSafe("agent")
    lines = lines.withColumn("opens", opens).withColumn("grp", F.sum(F.col("opens").cast("int")).over(order))
    within = Window.partitionBy("origin", "grp").orderBy("at")
    lines = lines.withColumn("blanks", F.sum((F.col("kind") == "blank").cast("int")).over(within)).where("grp > 0 AND blanks = 0 AND kind <> 'blank'")
    named, own = F.lower(F.col("value")), agent.partition("/")[0].lower()
    is_agent = F.col("kind") == "agent"
    groups = lines.groupBy("origin", "grp").agg(
        F.max(is_agent & (F.col("value") == "*")).alias("any"), F.max(is_agent & F.lit(own).contains(named)).alias("fits"), F.max(F.col("kind") == "rule").alias("ruled")
    ).where("ruled AND (any OR fits)")
    chosen = groups.groupBy("origin").agg(F.coalesce(F.min(F.when(~F.col("any"), F.col("grp"))), F.min(F.when(F.col("any"), F.col("grp")))).alias("grp"))
    rules = lines.where(F.col("field").isin("allow", "disallow")).join(chosen, ["origin", "grp"])
    return rules.select("origin", F.col("at").alias("place"), ((F.col("field") == "allow") | (F.col("value") == "")).alias("allow"), F.col("value").alias("pattern"))


def robots_allowed(urls: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """Add `allowed` to rows with an address, by rules (origin, place, allow, pattern) taken from the origins' robots files for this agent (`robots_rules`).

    The first rule of the origin, by place, whose pattern the path begins with decides; a star in it is a character like any other, and a rule without
    a pattern allows all. Origins without rules, or whose file could not be read, allow all. Rules are grouped by origin before they are joined.
    """
    at, way, of, listed = (free_name(urls, x) for x in ("robots_at", "robots_path", "robots_origin", "robots_rules"))
    origin = F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1), "^$", "/")
    path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    grouped = rules.groupBy(F.col("origin").alias(of)).agg(F.array_sort(F.collect_list(F.struct("place", "allow", "pattern"))).alias(listed))
    fits = F.filter(listed, lambda r: F.col(way).startswith(r["pattern"]))
    first = F.get(fits, F.lit(0))
    joined = urls.withColumns({at: origin, way: path}).join(grouped, F.col(at) == F.col(of), "left")
    return joined.withColumn("allowed", F.coalesce(first["allow"] | (first["pattern"] == ""), F.lit(True))).drop(at, way, of, listed)


def not_listed(df: DataFrame, url: str, digests: DataFrame) -> DataFrame:
    """The rows whose host's MD5 is not among `digests` (one column): a blacklist that names no host."""
    md5, digest = free_name(df, "host_md5"), free_name(df, "listed_md5")
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return df.withColumn(md5, F.md5(host.cast("binary"))).join(digests.toDF(digest), F.col(md5) == F.col(digest), "left_anti").drop(md5)
