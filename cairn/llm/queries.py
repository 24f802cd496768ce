"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, mixing, quality, sharding, simhash, suffixes, tokens, toxicity, trie, urlfilter, whitening
from .common import materialize, table, words_of


#: Verdicts and the host/path rules that the URL query applies.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

#: Labelled rows, about, whose texts are gathered to learn from.
LABELLED_ROWS = 200_000


def held_out(doc_id: str) -> Column:
    """Whether a row's labels are kept from learning."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = decontam.question_and_answer(table(spark, sf_dir, "benchmark").select("item_id", "text"), "text")
    found = decontam.contaminated(table(spark, sf_dir, "documents"), "doc_id", "text", items, "item_id", "question", "answer")
    return found.select("doc_id", "item_id", "question_overlap", "answer_overlap")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: those of rows that are not held out; toxicity() takes about 20,000 of them, and no more than 200,000, by a hash of the id, are joined to their texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id") & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    share = min(1.0, LABELLED_ROWS / max(1, labels.count()))
    labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    out = toxicity.toxicity(docs, "text", docs.join(F.broadcast(labels), "doc_id"), "toxic")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "votes")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: every address at which some page has a title with three or more of the characters # * $ %."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    title = F.regexp_extract(F.coalesce("html", F.lit("")), "(?s)<title>([^<]*)", 1)
    spam = pages.where(F.length(title) - F.length(F.translate(title, "#*$%", "")) >= 3)
    out = urlfilter.filter_urls(pages.select("page_id", "url"), "url", spam.select(urlfilter.canonical(F.col("url"))), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed")


def conversation_log(rows: DataFrame) -> DataFrame:
    """An event log that rebuilds the conversations (conv_id, turn, role, text; no null texts).

    Messages are told in different ways, by their place: whole; as a start and two deltas; wrong, then
    regenerated and streamed; or wrong, then edited. A message that is deleted again comes at the end of some. What makes a turn anew comes
    before anything of a later turn, as it discards that.
    """
    told = chat.messages_as_events(rows)
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substr(F.col("text"), F.lit(1), half), F.substr(F.col("text"), half + 1)
    one = lambda k, event, text, role=None: F.struct(
        (F.col("turn") * 10 + k).cast("long").alias("seq"), F.col("turn").cast("long").alias("turn"), F.lit(event).alias("event"), (F.col("role") if role is None else role).alias("role"), text.alias("text")
    )
    none = F.lit(None).cast("string")
    ways = F.when(F.col("turn") % 4 == 1, F.array(one(0, "message", F.col("text"))))
    ways = ways.when(F.col("turn") % 4 == 2, F.array(one(0, "message", F.lit("")), one(1, "delta", first, none), one(2, "delta", second, none)))
    ways = ways.when(F.col("turn") % 4 == 3, F.array(one(0, "message", F.lit("wrong")), one(1, "regenerate", none, none), one(2, "delta", first, none), one(3, "delta", second, none)))
    ways = ways.otherwise(F.array(one(0, "message", F.lit("wrong")), one(1, "edit", F.col("text"), none)))
    gone = F.array(*[F.struct((F.col("turn") * 10 + k).cast("long").alias("seq"), (F.col("turn") + 1).cast("long").alias("turn"), F.lit(event).alias("event"), F.lit("user").alias("role"), F.lit("gone").alias("text")) for k, event in ((5, "message"), (6, "delete"))])
    events = F.when(F.col("turn") % 5 == 0, F.concat(ways, gone)).otherwise(ways)
    return told.select("conv_id", F.explode(events).alias("e")).select("conv_id", "e.*")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows are told as an event log first, with deltas, edits, regenerations and deletions, from which the operator rebuilds them."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    out = chat.render(chat.fold_events(conversation_log(rows.unionByName(more))))
    read = out.select("conv_id", "formatted", "loss_mask", chat.read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss_mask")), "")
    digests = read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return digests.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_filter(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key")
    )
    out = sharding.lpt_shards(materialize(rows), "text_key", "size", 24, order=("doc_id",))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
    out = mixing.systematic_mix(materialize(rows), "doc_id", "source", "size")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (host: their source) and pages (host and suffix of the address, declared language of the markup) together.

    The text model is fitted on documents that are not held out. page_id is null for documents, doc_id for pages.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", "lang", F.col("source").alias("host"), F.lit(None).cast("string").alias("declared"))
    html, url = F.coalesce("html", F.lit("")), F.col("url")
    visible = F.regexp_replace(F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->", " "), "<[^>]*>", " ")
    declared = F.nullif(F.lower(F.regexp_extract(html, "(?i)<html[^>]*\\blang=[\"']?([A-Za-z]+)", 1)), F.lit(""))
    pages = table(spark, sf_dir, "pages").select(
        F.lit(None).cast("long").alias("doc_id"), "page_id", visible.alias("text"), F.lit(None).cast("string").alias("lang"), F.nullif(urlfilter.host_of(url), F.lit("")).alias("host"), declared.alias("declared")
    )
    suffix = F.when(F.col("page_id").isNotNull(), F.substring_index("host", ".", -1))
    labelled = docs.where(~held_out("doc_id")).select("text", "lang")
    out = langid.identify(docs.unionByName(pages), "text", labelled, "lang", F.col("host"), suffix, F.col("declared"), keep_text=False)
    return out.select("doc_id", "page_id", "language", "confidence", "accepted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_token_counts(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """`model`: the path of a SentencePiece model; that of the public 32k vocabulary if none is given."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, "text", model, limit=4096).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", most=16)
    each = out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c"))
    return each.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


#: White space as DuckDB's regular expressions write it.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HOST = _LOWER.format(r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")
_PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"


def _escaped(text: str) -> str:
    out = f"replace({text}, '{chat.ESC}', '{chat.ESC}e')"
    for control, code in chat.CODES.items():
        out = f"replace({out}, '{control}', '{chat.ESC}{code}')"
    return out


_TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def _overlap(part: str) -> str:
    """Of each item, the share of the shingles of a part that each document has, as a CTE body."""
    return f"""SELECT h.doc_id, s.item_id, count(*) / any_value(s.n)::DOUBLE AS share FROM (
        SELECT *, count(*) OVER (PARTITION BY item_id) AS n FROM (SELECT DISTINCT item_id, unnest(list_transform(range(1, len({part}) - least(5, len({part})) + 2),
            lambda i: array_to_string({part}[i:i + least(5, len({part})) - 1], ' '))) AS g FROM b WHERE len({part}) > 0)) s
        JOIN g h ON s.g = h.g GROUP BY h.doc_id, s.item_id"""


#: crc32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1), lambda i: [unicode({0}[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, CASE WHEN xor(a, e) & 1 = 1 THEN 3988292384 ELSE 0 END)))"""

ORACLES = {
    "op1_decontamination": rf"""
        WITH i AS (SELECT item_id, coalesce(text, '') AS text, regexp_extract(coalesce(text, ''), '(?s)^(.*[.?!])\s+(\S.*)$', 2) AS answer FROM benchmark),
        b AS (SELECT item_id, {_TOKENS.format("CASE WHEN answer = '' THEN text ELSE regexp_extract(text, '(?s)^(.*[.?!])\\s+(\\S.*)$', 1) END")} AS q, {_TOKENS.format("answer")} AS a FROM i),
        d AS (SELECT doc_id, {_TOKENS.format("coalesce(text, '')")} AS w FROM documents),
        k AS (SELECT DISTINCT unnest([least(5, len(q)), least(5, len(a))]) AS k FROM b),
        g AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM d, k WHERE k > 0)),
        x AS ({_overlap("q")}),
        y AS ({_overlap("a")})
        SELECT x.doc_id, x.item_id, x.share AS question_overlap, CASE WHEN len(b.a) = 0 THEN 1.0::DOUBLE ELSE y.share END AS answer_overlap
        FROM x JOIN b ON x.item_id = b.item_id LEFT JOIN y ON x.doc_id = y.doc_id AND x.item_id = y.item_id
        WHERE x.share >= 0.8 AND (len(b.a) = 0 OR y.share >= 0.8)""",
    "op3_url_filters": rf"""
        WITH u AS (SELECT page_id, url, html, {_HOST} AS host, {_PATH} AS path, regexp_extract(coalesce(html, ''), '<title>([^<]*)', 1) AS title,
            list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^[^#?]*\?([^#]*)', 1), '&'),
                lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params FROM pages),
        c AS (SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
            || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical_url FROM u),
        l AS (SELECT DISTINCT canonical_url AS x FROM c WHERE length(title) - length(translate(title, '#*$%', '')) >= 3),
        r(verdict, h, p) AS (VALUES {', '.join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES)}),
        f AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS v
            FROM c JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(v, CASE WHEN x IS NULL THEN 'allow' ELSE 'block' END) AS verdict, canonical_url, x IS NOT NULL AS listed
        FROM c LEFT JOIN l ON canonical_url = x LEFT JOIN f USING (page_id)""",
    "op4_chat_format": rf"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        g AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
            coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
            sum({len(chat.START) + len(chat.END) + 2} + length(replace({_escaped('role')}, chr(10), '{chat.ESC}n')) + length({_escaped('text')}))::BIGINT AS formatted_chars
            FROM c GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""",
    "op7_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        i AS (SELECT row_number() OVER () AS k, *, length(translate(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
            length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
        p AS (SELECT k, w, unnest(range(1, len(w) - 1)) AS j FROM i),
        n AS (SELECT k, j, count(*) OVER (PARTITION BY k, w[j], w[j + 1], w[j + 2]) AS c FROM p),
        q AS (SELECT k, count(DISTINCT x) AS r FROM (SELECT k, unnest([j, j + 1, j + 2]) AS x FROM n WHERE c > 1) GROUP BY k),
        b AS (SELECT doc_id, text, len(w)::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            coalesce(r, 0)::BIGINT AS n_repeat_words, length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS letters, length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS capitals,
            length(text) - length(translate(text, '!?', '')) AS marks, len(string_split(text, chr(10))) AS n_lines FROM i LEFT JOIN q USING (k)),
        v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR word_chars > 20 * n_words OR word_chars < 2 * n_words OR 5 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
                OR 10 * marks > 3 * n_words OR 2 * letters < word_chars OR 10 * capitals > 3 * greatest(30, letters)) AS kept FROM v""",
    "op9_mixing": rf"""
        WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::BIGINT AS weight, source_size * 2 AS full_size FROM s),
        o AS (SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(full_size) OVER p, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS share
              FROM w WINDOW p AS (ORDER BY full_size::DOUBLE / weight, weight, full_size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT *, CASE WHEN share * weight < full_size THEN max(CASE WHEN share * weight < full_size THEN share END) OVER () * weight ELSE full_size END::DOUBLE AS target FROM o),
        r AS (SELECT d.*, row_number() OVER (PARTITION BY d.source ORDER BY -(length(size::VARCHAR) * 100 + left(size::VARCHAR || '0', 2)::INT), md5(coalesce(doc_id::VARCHAR, '')), size) AS k FROM d),
        e AS (SELECT r.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
                     ('0x' || left(md5(coalesce(r.source, '') || ':mix'), 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target, (size * (floor(k::DOUBLE * each + u) - floor((k - 1)::DOUBLE * each + u)))::BIGINT AS taken FROM e""",
    "op11_prefix_trie": rf"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS own FROM t GROUP BY conv_id),
        h AS (SELECT *, {_CRC32.format("(conv_id::VARCHAR)")} % 9 AS h FROM o),
        b AS (SELECT h.conv_id, list_concat(coalesce(o.own[1:h], []), h.own[h + 1:]) AS turns FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % 5),
        p AS (SELECT conv_id, d, to_json(turns[1:d])::VARCHAR AS path, to_json(turns[1:d - 1])::VARCHAR AS up, coalesce(strlen(turns[d].text), 0) AS size, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM b)),
        n AS (SELECT path, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saves, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ended FROM p GROUP BY path, d),
        k AS (SELECT up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY up),
        f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.path = k.up),
        s AS (SELECT p.path, sum(f.saves) AS saved, count(*) FILTER (f.n_children = 0) AS n_leaves FROM f JOIN p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.path)
        SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(f.ended) AS ends_sha256
        FROM f JOIN s USING (path) LEFT JOIN n u ON f.d > 0 AND u.path = f.up""",
}

QUERIES = {
    f.__name__: f
    for f in (op1_decontamination, op2_toxicity, op3_url_filters, op4_chat_format, op5_suffix_dedup, op6_simhash, op7_quality_rules, op8_sharding, op9_mixing, op10_language_id, op11_prefix_trie, op12_token_counts, op13_whitening)
}
