"""Tasks for a collection run and what snapshots of services tell of them: files to fetch, galleries, properties, pages and their concepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions import passages as P
from cairn.functions import text, wiki

from . import gates
from .relational import first_wins, free_name, global_rank, stride_shard

#: Fixed value: files of one question to the service.
BATCH = 50


def file_tasks(concepts: DataFrame, done: DataFrame, order: str, size: int = BATCH) -> DataFrame:
    """(batch, qid, file): the files that concepts (qid, p18 array) name and `done` (qid, file) lacks, in batches of `size`, in the concepts' order; a size of 0 or less makes batches of one."""
    each = concepts.select("qid", F.col(order).alias("_order"), F.posexplode("p18").alias("_at", "file")).withColumn("file", text.file_name(F.col("file")))
    open_ = each.where(F.coalesce("file", F.lit("")) != "").join(done.select("qid", "file").distinct(), ["qid", "file"], "left_anti")
    ranked = global_rank(open_, "_order", ["_at", "qid", "file"], "_rank")
    return ranked.select(F.floor(F.col("_rank") / max(1, size)).alias("batch"), "qid", "file")


def ledger_tasks(ledger: DataFrame, done: DataFrame, order: str, shard: int, shards: int, tiers: tuple[str, ...] | None = None) -> DataFrame:
    """(qid, file): a shard's share of the files that a ledger (qid, file, tier) names, each once, less those that `done` has. Without `tiers` all count: a file of tasks."""
    rows = ledger if tiers is None else ledger.where(F.col("tier").isin(*tiers))
    # The first of a task is all that is left of it, so a plain minimum does (null first), which is kept in a hash table without a sort.
    first = F.when(F.count(order) == F.count("*"), F.min(order)).alias(order)
    once = rows.groupBy("qid", "file").agg(first)
    mine = stride_shard(global_rank(once, order, ["qid", "file"], "_rank"), "_rank", shard, shards)
    return mine.select("qid", "file").join(done.select("qid", "file").distinct(), ["qid", "file"], "left_anti")


def candidate_lines(lines: DataFrame, line: str, shard: int, shards: int, sources: Column | None = None, limit: int | None = None) -> DataFrame:
    """A shard's share of the lines by their number in the file, and of these the ones that `sources` lets pass, the first `limit`.

    Blank and malformed lines count for the numbers, as they do in the file.
    """
    mine = lines.where(F.col(line) % shards == shard)
    mine = mine if sources is None else mine.where(F.coalesce(sources, F.lit(False)))
    return mine if limit is None else mine.orderBy(line).limit(limit)


def embedded_images(pages: DataFrame, order: str) -> DataFrame:
    """(file, qid): every image of the pages (qid, page_id, images) once, with the concept of the first page that has it; pages without concept count as `pid:` and their number."""
    owner = F.coalesce("qid", F.concat(F.lit("pid:"), F.col("page_id").cast("string")))
    each = pages.select(owner.alias("qid"), F.col(order).alias("_order"), F.posexplode("images").alias("_at", "file")).where(F.coalesce("file", F.lit("")) != "")
    return first_wins(each, ["file"], ["_order", "_at"]).select("file", "qid")


def with_file_info(tasks: DataFrame, infos: DataFrame) -> DataFrame:
    """Tasks (file, …) with what the service tells of the file in `infos` (title, …): joined whatever case, underscores and the prefix `File:`; files it does not know go."""
    key = lambda c: text.title_key(F.regexp_replace(c, "^File:", ""))
    by = max((free_name(x, "file_key") for x in (tasks, infos)), key=len)
    known = first_wins(infos.withColumn(by, key(F.col("title"))), [by], ["title"])
    return tasks.withColumn(by, text.title_key(F.col("file"))).join(known.drop("title"), by).drop(by)


def merged_rounds(rounds: DataFrame) -> DataFrame:
    """(title, files, text) of the pages that a service told in several rounds (batch, round, title, files, text): the parts of a page within a batch put together in the order of the rounds.

    Rounds beyond the sixth of a batch are not asked for; null parts add nothing. A page of two batches gives two rows.
    """
    parts = F.array_sort(F.collect_list(F.struct("round", F.coalesce("files", F.array().cast("array<string>")).alias("files"), F.coalesce("text", F.lit("")).alias("text"))))  # six at most
    grouped = rounds.where(F.col("round") < 6).groupBy("batch", "title").agg(parts.alias("parts"))
    return grouped.select("title", F.flatten(F.transform("parts", lambda p: p["files"])).alias("files"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))


def gallery_files(galleries: DataFrame, redirects: DataFrame, pages: DataFrame) -> DataFrame:
    """(qid, file, caption): the images of each concept's gallery.

    `galleries` has (qid, title), `redirects` (source, target) and `pages` (title, files, text)
    of the pages that the titles led to. A page counts for the concepts of the title
    that was redirected to it, or else of its own.
    """
    name = lambda c: wiki.file_key(F.col(c))
    back = first_wins(redirects.select(name("target").alias("page"), name("source").alias("asked")), ["page"], ["asked"])
    files = F.filter(F.array_distinct(F.transform("files", lambda f: wiki.file_key(F.regexp_replace(f, "^File:", "")))), wiki.is_image)
    shown = pages.select(name("title").alias("page"), files.alias("files"), F.map_from_entries(wiki.captions(F.col("text"))).alias("captions"))
    owned = shown.join(back, "page", "left").withColumn("title", F.coalesce("asked", "page")).join(galleries.select("qid", name("title").alias("title")), "title")
    return owned.select("qid", F.explode("files").alias("file"), "captions").select("qid", "file", F.coalesce(F.col("captions")[F.col("file")], F.lit("")).alias("caption"))


def image_properties(triples: DataFrame, concepts: DataFrame) -> DataFrame:
    """(qid, prop, role, file): images of the concepts (qid) among triples (qid, prop, value) whose value is a file; properties that are none and files that are no images go."""
    named = triples.where(F.col("value").contains("Special:FilePath/") & ~F.col("prop").isin(*wiki.NO_IMAGE)).withColumn("file", F.replace(text.file_name(F.col("value")), F.lit("_"), F.lit(" ")))
    kept = named.where(wiki.is_image(F.col("file"))).join(concepts.select("qid").distinct(), "qid", "left_semi")
    return kept.select("qid", "prop", wiki.image_role(F.col("prop")).alias("role"), "file")


def attach_concepts(pages: DataFrame, concepts: DataFrame, order: str) -> DataFrame:
    """Pages (lang, page_id, …) with the `qid` of the concept that has them as one of its `sides`, an array of (lang, page_id); the last concept wins. Pages of none stay, without a qid."""
    sides = concepts.select("qid", F.col(order).alias("_order"), F.explode("sides").alias("_s")).where("_s.page_id is not null")
    last = sides.groupBy(F.col("_s.lang").alias("lang"), F.col("_s.page_id").alias("page_id")).agg(F.max_by("qid", "_order").alias("qid"))
    return pages.drop("qid").join(last, ["lang", "page_id"], "left")


def wiki_documents(pages: DataFrame) -> DataFrame:
    """(qid, lang, title, url, page_sha, n_passages, markdown, content_sha, page_bytes, path, authority): the pages (lang, title, text, redirect, qid) that pass the gate, as Markdown."""
    parsed = pages.withColumn("_md", wiki.markdown(F.col("title"), wiki.sections(F.coalesce("text", F.lit(""))))).withColumn("markdown", F.col("_md.markdown"))
    unclear = wiki.wiki_lists(F.coalesce("text", F.lit("")))["disambiguation"]
    kept = parsed.where(gates.wiki_gate(F.col("redirect"), unclear, F.col("qid"), F.col("markdown")))
    url = text.page_url(F.col("lang"), F.col("title"))
    return kept.withColumn("url", url).withColumn("page_sha", F.sha2(F.col("url").cast("binary"), 256)).select(
        "qid", "lang", "title", "url", "page_sha", F.col("_md.n_passages").alias("n_passages"), "markdown", F.sha2(F.col("markdown").cast("binary"), 256).alias("content_sha"),
        F.octet_length("markdown").alias("page_bytes"), page_path(F.col("page_sha")).alias("path"), F.lit("wiki").alias("authority"),
    )


def page_path(sha: Column) -> Column:
    return F.concat(F.lit("pages/"), F.substring(sha, 1, 2), F.lit("/"), sha, F.lit(".md"))


def ingested(rows: DataFrame) -> DataFrame:
    """Rows (title, url, text, …) from outside as documents, by the passages and the gate of crawled pages: adds page_sha, passages, path, content_sha, page_bytes, authority, n_images.

    A row without an address is known as `offline:` and its title.
    """
    url = F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit("offline:"), F.coalesce("title", F.lit(""))))
    out = rows.withColumns({"page_sha": F.sha2(url.cast("binary"), 256), "passages": P.passages(F.col("text"))})
    out = out.where(gates.shell_page_gate(F.transform("passages", lambda p: p["text"])))
    return out.withColumns({
        "path": page_path(F.col("page_sha")), "content_sha": F.sha2(F.col("text").cast("binary"), 256), "page_bytes": F.octet_length("text"), "authority": F.lit("offline-dump"),
        "n_images": F.aggregate(F.transform("passages", lambda p: F.size(p["images"])), F.lit(0), lambda a, n: a + n),
    })


def crawled(pages: DataFrame, known: DataFrame) -> DataFrame:
    """(page_sha, url, path, content_sha, body): crawled pages to store, the first of each address that the ledger `known` (page_sha) lacks; pages without a body come again another time."""
    body = pages.where(F.coalesce(F.trim("body"), F.lit("")) != "").withColumn("page_sha", F.sha2(F.col("url").cast("binary"), 256))
    new = first_wins(body.select("page_sha", "url", "body", "at"), ["page_sha"], ["at"]).join(known.select("page_sha").distinct(), "page_sha", "left_anti")
    return new.select("page_sha", "url", page_path(F.col("page_sha")).alias("path"), F.sha2(F.col("body").cast("binary"), 256).alias("content_sha"), "body")


def projected_record(df: DataFrame, told: dict[str, str]) -> DataFrame:
    """Rows in which what was measured goes before what was declared, column by column (declared: measured); a measure of 0 counts as none."""
    return df.withColumns({declared: F.coalesce(F.nullif(measured, F.lit(0)), declared) for declared, measured in told.items()}).drop(*told.values())


def hash_route(sha: Column, readers: int) -> Column:
    """The reader, of `readers`, of a digest: its first two digits, read as a number, by the remainder."""
    return (F.conv(F.substring(sha, 1, 2), 16, 10).cast("int") % readers).cast("int")


def retire_stale(ledger: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that a ledger still has and the current mirror lacks."""
    return ledger.select(*keys).distinct().join(current.select(*keys).distinct(), keys, "left_anti")


#: Seconds to wait after a refusal, the last for all later ones.
BACK_OFF = (30, 120, 300)


def back_off(attempt: Column) -> Column:
    """Seconds to wait after the 0-based attempt."""
    return F.get(F.array(*map(F.lit, BACK_OFF)), F.least(attempt, F.lit(len(BACK_OFF) - 1)))
