"""Dumps, numbered lines, the tail source and rules moved by timers, against plain Python."""

from __future__ import annotations

import gzip
import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cairn.operators import control
from cairn.sources import readers
from cairn.sources.tail import Range, TailReader, TailSource
from cairn.streaming import timers

ESCAPES = {"\n": "\\n", "\r": "\\r", "\0": "\\0", "\x1a": "\\Z", "'": "\\'", '"': '\\"', "\\": "\\\\"}


def quoted(text: str, doubled: bool = False) -> str:
    return "'" + "".join("''" if doubled and c == "'" else ESCAPES.get(c, c) for c in text) + "'"


def dump_row(name, size, metadata="", media="'BITMAP'", doubled=False):
    return f"({quoted(name, doubled)},{size},1,1,{quoted(metadata, doubled)},8,{media},'image','jpeg')"


def test_dump_fields_of_a_megabyte_and_quotes_at_every_border(spark, tmp_path):
    borders = ["'", "\\", "''", "\\'", "'\\", "\\\\", "\n", '"', "),(", "','", "x"]
    names = [a + "n" + b for a, b in itertools.product(borders, borders)]
    long = "".join(borders) * 60_000
    rows = [dump_row(n, 60_000 + i, long if i == 7 else n, doubled=i % 2 == 1) for i, n in enumerate(names)]
    lines = ["-- a comment", "INSERT INTO `image` VALUES " + ",".join(rows[:50]) + ";", "INSERT INTO `image` (`img_name`, `img_size`) VALUES", *[r + "," for r in rows[50:]]]
    (tmp_path / "i.sql").write_text("\n".join(lines) + "\n", newline="")
    got = readers.sql_dump_tuples(spark, str(tmp_path / "i.sql")).collect()
    assert sorted((r.fname, r.size) for r in got) == sorted((n, 60_000 + i) for i, n in enumerate(names))


def test_dump_rows_of_other_shapes(spark, tmp_path):
    lines = [
        "INSERT INTO `image` VALUES " + ",".join([dump_row("BITMAP", 60_000, media="NULL"), dump_row("d(1).svg", 70_000, media="'DRAWING'"), dump_row("small", 9), dump_row("good%", 60_001)]),
        "('torn,60000,1,1,'',8,'BITMAP')," + dump_row("inside", 60_000), "('n',60000,1,1,NULL,8,'BITMAP')", "", "('%\\_\\%',60002,1,1,'',8,'BITMAP'),",
    ]
    (tmp_path / "i.sql").write_text("\n".join(lines))
    assert sorted(r.fname for r in readers.sql_dump_tuples(spark, str(tmp_path / "i.sql")).collect()) == ["%\\_\\%", "good%"]


def test_lines_of_many_ranges_have_the_numbers_of_one_pass(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 90) if i % 7 else "" for i in range(5000)]
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "plain" / "b.txt").write_text("only")
    with gzip.open(tmp_path / "plain" / "c.gz", "wt") as f:
        f.write("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = readers.numbered_lines(spark, str(tmp_path / "plain"))
        assert spark.read.text(str(tmp_path / "plain")).rdd.getNumPartitions() > 10
        got = defaultdict(dict)
        for r in df.collect():
            got[r.file.rpartition("/")[2]][r.line] = r.value
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["a.txt"] == got["c.gz"] == dict(enumerate(lines)) and got["b.txt"] == {0: "only"}


def read_all(reader, start, end):
    return [x for p in reader.partitions(start, end) for x in reader.read(p)]


@pytest.mark.parametrize("part", [1, 3, 1 << 20])
def test_tail_waits_for_whole_lines_and_survives_rotation(tmp_path, part):
    path = tmp_path / "log"
    reader = TailReader(str(path), part)
    start = reader.initialOffset()
    assert reader.latestOffset() == start
    path.write_text("a\nbcd\npart")
    first = reader.latestOffset()
    assert read_all(reader, start, first) == [("a", 2), ("bcd", 6)] and first["at"] == 6
    with path.open("a") as f:
        f.write("ial\n\nx")
    second = reader.latestOffset()
    assert [line for line, _ in read_all(reader, first, second)] == ["partial", ""]
    path.write_text("a\n")  # cut short
    third = reader.latestOffset()
    assert [line for line, _ in read_all(reader, second, third)] == ["a"]
    (tmp_path / "new").write_text("a\nb\nc\n")
    (tmp_path / "new").rename(path)  # another file with the same first line
    assert [line for line, _ in read_all(reader, third, reader.latestOffset())] == ["a", "b", "c"]
    path.unlink()
    assert reader.latestOffset() == reader.planned


def test_tail_batches_are_bounded_and_go_on_after_a_restart(tmp_path):
    path, lines = tmp_path / "log", [f"{i}-" + "y" * (i % 40) for i in range(500)]
    path.write_text("\n".join(lines) + "\n" + "z" * 300 + "\n")
    reader, got, batches = TailReader(str(path), 50, 200, str(tmp_path / "position")), [], 0
    start = reader.initialOffset()
    while (end := reader.latestOffset()) != start:
        assert end["at"] - start["at"] <= 200 or end["at"] - start["at"] == 301
        got += [line for line, _ in read_all(reader, start, end)]
        start, batches = end, batches + 1
        if batches % 5 == 0:
            reader = TailReader(str(path), 50, 200, str(tmp_path / "position"))
    assert got == [*lines, "z" * 300] and batches > 40


def test_tail_ends_past_the_end_of_a_file(tmp_path):
    path = tmp_path / "log"
    path.write_text("a\nb\n")
    reader = TailReader(str(path))
    file = reader.latestOffset()["file"]
    assert list(reader.read(Range(file, 0, 100))) == [("a", 2), ("b", 4)] and list(reader.read(Range(file, 50, 100))) == []
    assert list(reader.read(Range("another", 0, 4))) == []
    strict = TailReader(str(path), strict=True)
    for lost in (Range("another", 0, 4), Range(file, 0, 100)):
        with pytest.raises(OSError, match="no longer has"):
            list(strict.read(lost))
    path.unlink()
    assert list(reader.read(Range(file, 0, 4))) == []


def test_tail_as_a_stream_with_a_rotation_and_restarts(spark, tmp_path):
    spark.dataSource.register(TailSource)
    log, out, offsets = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "offsets")
    for lines, mode in (("a\nb\n", "w"), ("c\nd", "a"), ("\n", "a"), ("e\nf\ng\n", "new")):
        if mode == "new":
            (tmp_path / "fresh").write_text(lines)
            (tmp_path / "fresh").rename(log)
        else:
            with log.open(mode) as f:
                f.write(lines)
        stream = spark.readStream.format("cairn_tail").option("path", str(log)).option("partBytes", 2).option("batchBytes", 4).option("position", str(tmp_path / "position")).load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r.line for r in spark.read.parquet(out).collect()) == list("abcdefg")


def drained(stream, tmp_path, name):
    out, offsets = str(tmp_path / name), str(tmp_path / f"{name}-offsets")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(out).collect()


def plain_log(rows, ban):
    """Every call and every ban that lapses, engine by engine."""
    out = []
    for engine in {r[0] for r in rows}:
        errors, until = 0, None
        for at, bad in sorted((at, bad) for e, at, bad in rows if e == engine):
            if until is not None and until < at:
                out.append((engine, until, errors, until, "over"))
                until = None
            errors, until = (errors + 1, at + ban) if bad else (0, None)
            out.append((engine, at, errors, until, "fail" if bad else "ok"))
        if until is not None:
            out.append((engine, until, errors, until, "over"))
    return out


def test_timers_follow_calls_out_of_order_with_a_hot_engine(spark, tmp_path):
    """Nine of ten calls are of one engine, batches overlap by up to the watermark's delay, and a ban may end in a later batch."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.9 else f"e{rng.randrange(3)}", t, rng.random() < 0.4) for t in range(86_400, 116_400, 11)]
    keyed = [(min(3, max(0, (t - 86_400 + rng.randrange(-900, 900)) // 7500)), r) for r in rows for t in [r[1]]]
    source = str(tmp_path / "in")
    for k in range(4):
        part = [r for b, r in keyed if b == k]
        rng.shuffle(part)
        spark.createDataFrame(part, "host string, s long, bad boolean").select("host", F.timestamp_seconds("s").alias("at"), "bad", (~F.col("bad")).alias("ok")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("host string, at timestamp, bad boolean, ok boolean").option("maxFilesPerTrigger", 1).parquet(source).withWatermark("at", "1800 seconds")
    settled = (rows[-1][1] - 1800) // 60 * 60
    for ban in (30, 400):
        got = [(r.engine, int(r.at.timestamp()), r.errors, r.until and int(r.until.timestamp()), r.event) for r in drained(timers.suspension_log(stream, "host", "at", "ok", float(ban)), tmp_path, f"log{ban}")]
        assert sorted(x for x in map(repr, got) if eval(x)[1] < settled) == sorted(repr(x) for x in plain_log(rows, ban) if x[1] < settled)
    acts, last = [], {}
    for host, at, bad in rows:
        if bad and at - last.get(host, float("-inf")) > 600:
            acts.append((host, at))
            last[host] = at
    got = [(r.key, int(r.at.timestamp())) for r in drained(timers.cooldown(stream, "host", "at", "bad", 600), tmp_path, "acts")]
    assert sorted(x for x in got if x[1] < settled) == sorted(x for x in acts if x[1] < settled)
    batch = spark.createDataFrame(rows, "host string, s long, bad boolean").select("host", F.timestamp_seconds("s").alias("at"), (~F.col("bad")).alias("ok"))
    state = {r.engine: r.errors for r in control.suspensions(batch, "host", "at", "ok").collect()}
    assert state == {e: [x for x in plain_log(rows, 1) if x[0] == e and x[4] != "over"][-1][2] for e in state}
