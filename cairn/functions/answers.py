"""Answers that need no search: statistics, digests, random values, units, local times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The words that ask for a statistic and for a random value.
STATISTICS = ("min", "max", "avg", "sum", "prod", "range")
RANDOM = ("string", "int", "float", "sha256", "uuid", "color")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def statistic(query: Column) -> Column:
    """The value that "avg 1 2 3" and the like ask for; null for other words, no numbers, or anything that is no number."""
    parts = F.filter(F.split(F.coalesce(query, F.lit("")), "\\s+"), lambda p: p != "")
    numbers = F.transform(F.slice(parts, 2, 1 << 30), lambda p: F.replace(p, F.lit(","), F.lit("")).try_cast("double"))
    total = F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)
    product = F.aggregate(numbers, F.lit(1.0), lambda a, x: a * x)
    least, most = F.array_min(numbers), F.array_max(numbers)
    word = F.get(parts, F.lit(0))
    asked = (
        F.when(word == "min", least).when(word == "max", most).when(word == "avg", total / F.size(numbers))
        .when(word == "sum", total).when(word == "prod", product).when(word == "range", most - least)
    )
    return F.when((F.size(numbers) > 0) & ~F.exists(numbers, lambda x: x.isNull()), asked)


def digest(query: Column) -> Column:
    """The hex digest that "sha256 some text" and the like ask for; null for other words or no text."""
    word, text = F.lower(F.regexp_extract(query, "^\\s*(\\S+)\\s", 1)), F.regexp_extract(query, "(?s)^\\s*\\S+\\s+(.*)$", 1)
    raw = text.cast("binary")
    out = F.when(word == "md5", F.md5(raw)).when(word == "sha1", F.sha1(raw))
    for bits in (224, 256, 384, 512):
        out = out.when(word == f"sha{bits}", F.sha2(raw, bits))
    return F.when(text != "", out)


def random_value(query: Column) -> Column:
    """A value for "random color" and the like, new in every run; null for other queries."""
    letters = F.array(*map(F.lit, ALPHABET))
    draw = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.get(letters, F.pmod(F.xxhash64(F.uuid(), i), F.lit(len(ALPHABET))).cast("int")))
    text = F.array_join(draw, "")
    whole = (F.rand() * (1 << 32)).cast("long") - (1 << 31)
    color = F.concat(F.lit("#"), F.lpad(F.hex((F.rand() * 0x1000000).cast("long")), 6, "0"))
    word = F.regexp_extract(query, "^random (\\w+)$", 1)
    return (
        F.when(word == "string", text).when(word == "int", whole.cast("string")).when(word == "float", F.rand().cast("string"))
        .when(word == "sha256", F.sha2(text, 256)).when(word == "uuid", F.uuid()).when(word == "color", color)
    )


def convert_units(questions: DataFrame, key: str, query: str, units: DataFrame, words: tuple[str, ...] = ("in", "to", "as")) -> DataFrame:
    """(key, value, symbol) of questions such as "12.5 km in mi"; those that are none, or know no common quantity, give no row.

    `units` has (symbol, quantity, factor, shift, position): SI value = number * factor +
    shift. Symbols are not unique: source and target must share their quantity, and of several the
    last pair by position wins.
    """
    form = "(?s)^\\s*([-+]?)\\s*([\\d.,]+)([eE][-+]?\\d+)?\\s*(\\S+)\\s+(?:" + "|".join(words) + ")\\s+(\\S+)\\s*$"
    part = lambda i: F.regexp_extract(query, form, i)
    number = F.concat(part(1), F.replace(part(2), F.lit(","), F.lit("")), part(3)).try_cast("double")
    asked = questions.select(key, number.alias("_n"), part(4).alias("_from"), part(5).alias("_to")).where("_n is not null")
    side = lambda p: units.select(*[F.col(c).alias(f"_{p}_{c}") for c in ("symbol", "quantity", "factor", "shift", "position")])
    source = asked.join(side("s"), F.col("_from") == F.col("_s_symbol"))
    pairs = source.join(side("t"), (F.col("_to") == F.col("_t_symbol")) & (F.col("_s_quantity") == F.col("_t_quantity")))
    value = (F.col("_n") * F.col("_s_factor") + F.col("_s_shift") - F.col("_t_shift")) / F.col("_t_factor")
    best = pairs.groupBy(key).agg(F.max_by(F.struct(value.alias("value"), F.col("_t_symbol").alias("symbol")), F.struct("_s_position", "_t_position")).alias("_best"))
    return best.select(key, "_best.*")


def local_times(questions: DataFrame, key: str, query: str, now: Column, places: DataFrame, words: tuple[str, ...] = ("time", "clock", "timezone", "now")) -> DataFrame:
    """(key, zone, local): the local time of the place that a question names beside the words; without a place UTC, of an unknown place no row. `places` has (place, zone), places lower-cased and unique."""
    parts = F.filter(F.split(F.trim(query), " +"), lambda p: ~F.lower(p).isin(*words))
    asked = questions.select(key, F.lower(F.array_join(parts, " ")).alias("_place"), now.alias("_now"))
    joined = asked.join(places.select(F.col("place").alias("_name"), F.col("zone").alias("_zone")), F.col("_place") == F.col("_name"), "left")
    zone = F.coalesce("_zone", F.when(F.col("_place") == "", "UTC"))
    return joined.where(zone.isNotNull()).select(key, zone.alias("zone"), F.from_utc_timestamp("_now", zone).alias("local"))
