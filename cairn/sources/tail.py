"""A streaming source that follows a growing file of lines by byte offset."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a partition, of a micro-batch, and of a step in search of a line's end.
PART, BATCH, STEP = 64 << 20, 1 << 30, 1 << 16


class TailSource(DataSource):
    """Format `cairn_tail`: rows (line, at) of the file at the option `path`, `at` the byte where the line ends. Only whole lines are read; a partial one waits.

    For a folder that driver and executors share: the driver looks at lines' ends alone, and
    executors read byte ranges of what is new. A micro-batch has `batchBytes` at most (a longer line
    comes alone), its tasks `partBytes` each. Run it with a processing-time trigger, under which the
    batches follow each other; `availableNow` takes one batch a run.

    An offset names the file by its inode and the digest of its first line: one put in its place,
    or cut short, is read from its start, and a batch that is replayed after that gives what is left
    of its lines, or with `failOnDataLoss` an error. Rotation may repeat lines, so pair it with
    `merge_stream`. `position` names a small file, beside the checkpoint, that keeps the last planned
    offset: a query that starts again goes on by batches from there. Without it the first batch
    of a restart takes all that is there.
    """

    @classmethod
    def name(cls) -> str:
        return "cairn_tail"

    def schema(self) -> str:
        return "line string, at long"

    def streamReader(self, schema):  # noqa: N802
        o = self.options
        strict = o.get("failOnDataLoss", "false").lower() == "true"
        return TailReader(o["path"], int(o.get("partBytes", PART)), int(o.get("batchBytes", BATCH)), o.get("position"), strict)


@dataclass
class Range(InputPartition):
    """The lines that begin in the bytes [start, end) of a file."""

    file: str
    start: int
    end: int


def identity(f) -> str:
    """Names an open file by its inode and its first whole line; empty while it has none."""
    f.seek(0)
    line = f.readline(STEP)
    return f"{os.fstat(f.fileno()).st_ino}:{hashlib.md5(line).hexdigest()}" if line.endswith(b"\n") or len(line) == STEP else ""


def line_end(f, before: int, after: int) -> int:
    """Where the last line ends that ends at `before` or earlier but past `after`; else the first that ends later; `after` if none does."""
    end = before
    while end > after:
        start = max(after, end - STEP)
        f.seek(start)
        found = f.read(end - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        end = start
    f.seek(before)
    while chunk := f.read(STEP):
        found = chunk.find(b"\n")
        if found >= 0:
            return f.tell() - len(chunk) + found + 1
    return after


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, part: int = PART, batch: int = BATCH, position: str | None = None, strict: bool = False):
        self.path, self.part, self.batch, self.position, self.strict = path, part, batch, position, strict
        self.planned: dict | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        self.planned = {"file": "", "at": 0}
        return dict(self.planned)

    def _start(self) -> dict | None:
        """The offset that the last batch was planned up to, if it is known."""
        if self.planned is None and self.position and os.path.exists(self.position):
            with open(self.position) as f:
                self.planned = json.load(f)
        return self.planned

    def latestOffset(self) -> dict:  # noqa: N802
        """Where the next micro-batch ends: at the end of a whole line, `batch` bytes on at most."""
        start = self._start()
        if os.path.exists(self.path):
            with open(self.path, "rb") as f:
                file, size = identity(f), f.seek(0, os.SEEK_END)
                if file and start is None:
                    return {"file": file, "at": line_end(f, size, 0)}
                if file:
                    at = start["at"] if start["file"] == file and start["at"] <= size else 0
                    return {"file": file, "at": line_end(f, min(size, at + self.batch), at)}
        return dict(start or {"file": "", "at": 0})

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.planned = dict(end)
        if self.position:
            with open(f"{self.position}.new", "w") as f:
                json.dump(end, f)
            os.replace(f"{self.position}.new", self.position)
        first = start["at"] if start["file"] == end["file"] and start["at"] <= end["at"] else 0
        return [Range(end["file"], a, min(a + self.part, end["at"])) for a in range(first, end["at"], self.part)]

    def read(self, partition: Range) -> Iterator[tuple[str, int]]:
        """The lines of a range, as far as the file is still the one planned and still has them."""
        found = ""
        if os.path.exists(self.path):
            with open(self.path, "rb") as f:
                found = identity(f)
                if found == partition.file:
                    f.seek(max(0, partition.start - 1))
                    if partition.start:  # what runs into the range began before it
                        f.readline()
                    while f.tell() < partition.end:
                        line = f.readline()
                        if not line.endswith(b"\n"):
                            break
                        yield line[:-1].decode("utf-8", "replace"), f.tell()
                    else:
                        return
        if self.strict:
            raise OSError(f"{self.path} no longer has the bytes {partition.start} to {partition.end} of {partition.file}; it is {found or 'gone'}")

    def commit(self, end: dict) -> None:
        pass
