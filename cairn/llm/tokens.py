"""Token counts of whole texts, by a two-tier lookup within the map tasks.

A text falls into pre-tokens that no piece of the vocabulary joins, so the counts of the
pre-tokens sum up to the text's. A table of the frequent ones, learnt on a bounded sample and
broadcast, holds how many tokens each has; the others are encoded once a worker and kept in a
cache. Texts never leave their task, and no pre-token is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: Partitions that the frequent pre-tokens are learnt on, bytes of text taken of each, and entries of the table. They decide what is fast, never what is counted.
SAMPLED, SAMPLE_BYTES, FREQUENT = 64, 1 << 20, 1 << 16
#: Bytes of text that are split at once, entries of a worker's cache, and bytes of an entry that goes there.
SLICE, CACHED, SHORT = 8 << 20, 1 << 17, 64
#: How the library writes a space in its pieces.
BLANK = "▁"


class Pieces:
    """A SentencePiece model, opened once a worker, with the cache of what it has encoded."""

    _open: dict[str, Pieces] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cache: dict[bytes, int] = {}
        longer = [p for p in map(self.model.id_to_piece, range(self.model.get_piece_size())) if len(p) > 1]
        #: Whether each byte is a control character that no longer piece holds.
        self.alone = np.array([b < 0x20 and not any(chr(b) in p for p in longer) for b in range(256)])
        self.splits = self._keeps() and bool(self.alone[0x0A]) and not any(BLANK in p.lstrip(BLANK) for p in longer)

    @classmethod
    def at(cls, path: str) -> Pieces:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _keeps(self) -> bool:
        """Whether characters stay as they are and blanks are kept, with one more before the text. Else, or where a piece joins a blank to what stands before it, texts can't be split."""
        probe = "  aﬁ  é① Ａ　 . "
        ids = self.model.encode(probe)
        said = b"".join(bytes.fromhex(p[3:5]) if self.model.is_byte(i) else p.encode() for i, p in zip(ids, map(self.model.id_to_piece, ids), strict=True))
        return said.decode() == BLANK + probe.replace(" ", BLANK)

    def counts(self, pieces: list[bytes]) -> list[int]:
        """Tokens of each pre-token. A line feed before it keeps the library's own blank apart: two tokens more."""
        cache = self.cache
        new = [p for p in pieces if p not in cache]
        if not new:
            return [cache[p] for p in pieces]
        found = dict(zip(new, (len(x) - 2 for x in self.model.encode(["\n" + p.decode() for p in new], num_threads=1)), strict=True))
        out = [found[p] if p in found else cache[p] for p in pieces]
        if len(cache) + len(found) > CACHED:
            cache.clear()
        cache.update((p, n) for p, n in found.items() if len(p) <= SHORT)
        return out


def pre_tokens(texts: pa.Array, alone: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The pre-tokens of non-empty texts, as slices of one buffer, and the place where each text's begin.

    One is a byte that stands alone, or blanks and what follows up to the next blank or such a byte. A text begins with a blank, as in the library.
    """
    texts = pc.replace_substring(texts.cast(pa.large_string()), BLANK, " ")
    texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    body = np.frombuffer(data, np.uint8)[: starts[-1]]
    blank, control = body == 0x20, alone[body]
    cut = control.copy()
    cut[1:] |= (blank[1:] & ~blank[:-1]) | control[:-1]
    cut[starts[:-1]] = True
    cut[: starts[0]] = False
    places = np.flatnonzero(cut)
    ends = np.append(places, starts[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(ends), data]), np.searchsorted(places, starts[:-1])


def _token_counts(texts: pa.Array, pieces: Pieces, table: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """Tokens of non-empty texts."""
    if not pieces.splits:
        return np.array([len(x) for x in pieces.model.encode(texts.to_pylist(), num_threads=1)], np.int64)
    parts, begins = pre_tokens(texts, pieces.alone)
    coded = parts.dictionary_encode()
    kinds = coded.dictionary
    at = pc.index_in(kinds, value_set=table)
    known = at.is_valid().to_numpy(zero_copy_only=False)
    each = np.zeros(len(kinds), np.int64)
    each[known] = lengths[at.drop_null().to_numpy()]
    each[~known] = pieces.counts(kinds.filter(pa.array(~known)).to_pylist())
    return np.add.reduceat(each[coded.indices.to_numpy()], begins)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of whole texts of about SLICE bytes, a longer text alone."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy())
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + SLICE, "right")))
        yield texts.slice(start, end - start)
        start = end


def _frequent(texts: DataFrame, model: str) -> tuple[list[bytes], list[int]]:
    """The most frequent pre-tokens of the sample and their tokens.

    Every so many-th partition, SAMPLED at most, is read up to SAMPLE_BYTES; each gives its own most frequent, so FREQUENT rows in all meet on the driver.
    """
    step = max(1, math.ceil(texts.rdd.getNumPartitions() / SAMPLED))
    most = FREQUENT // SAMPLED

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, left = [], SAMPLE_BYTES
        if TaskContext.get().partitionId() % step or not Pieces.at(model).splits:
            return
        for batch in batches:
            for part in _slices(pc.filter(batch.column(0), pc.greater(pc.binary_length(batch.column(0)), 0))):
                if left > 0:
                    seen.append(pre_tokens(part, Pieces.at(model).alone)[0])
                    left -= pc.sum(pc.binary_length(part)).as_py()
            if left <= 0:
                break
        if seen:
            counts = pa.chunked_array(seen).value_counts()
            counts = counts.take(pc.array_sort_indices(counts.field("counts"), order="descending")[:most])
            words = counts.field("values")
            words = words.filter(pc.less_equal(pc.binary_length(words), SHORT)).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(Pieces.at(model).counts(words), pa.int32())], ["piece", "tokens"])

    rows = texts.mapInArrow(learn, "piece binary, tokens int").distinct().collect()
    return [bytes(r[0]) for r in rows], [r[1] for r in rows]


def count_tokens(df: DataFrame, text: str, model: str, limit: int = 4096) -> DataFrame:
    """Add `n_bytes` (UTF-8), `n_tokens` (long) and `over_limit` (more tokens than `limit`) for every whole text.

    `model` is the path of a SentencePiece model that every executor has. Begin and end marks are not
    added, and special strings within a text are text. Null and empty texts have no bytes and no
    tokens. Repeated rows are counted each; an empty table gives an empty result; columns with the
    added names are replaced. A model whose pieces would join pre-tokens is asked for whole texts instead.
    """
    df = df.drop("n_bytes", "n_tokens", "over_limit")
    sc = df.sparkSession.sparkContext
    words, lengths = _frequent(df.select(F.col(text).cast("string")), model)
    table = sc.broadcast((pa.array(words, pa.large_binary()), np.array(lengths, np.int64)))  # FREQUENT entries of SHORT bytes at most

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces.at(model)
        for texts in batches:
            out = np.zeros(len(texts), np.int64)
            full = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
            done = 0
            for part in _slices(texts.take(pa.array(full))):
                out[full[done : done + len(part)]] = _token_counts(part, pieces, *table.value)
                done += len(part)
            yield pa.array(out)

    body, count = F.coalesce(F.col(text).cast("string"), F.lit("")), free_name(df, "tokens")
    counted = df.withColumn("n_bytes", F.octet_length(body).cast("long")).withColumn(count, tokens(body))
    return counted.withColumnRenamed(count, "n_tokens").withColumn("over_limit", F.col("n_tokens") > limit)
