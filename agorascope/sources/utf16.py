"""UTF-16 text files as rows of lines, each file read by many tasks.

Spark's text reader splits files at bytes; in UTF-16 a line end is a whole code unit, and the same two bytes can lie across
two others. This data source deals out ranges of whole code units. A range has the lines that begin in it: its task skips
to the first line that does, and reads on past its end to finish the last one. Lines end with LF, CR LF or the file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from agorascope.session import ship

#: Bytes of a range, bytes read at once, and lines that are given to Spark at once.
RANGE, CHUNK, LINES = 32 << 20, 1 << 20, 4096
#: Tasks that ranges are dealt to before a task gets more than one, and bytes of a task's ranges then.
TASKS, TASK_BYTES = 64, 32 << 20
#: Bytes read at least, past the end of a range too.
MORE = 16 << 10
_MARKS = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, first: int, encoding: str):
        self.path, self.start, self.end, self.first, self.encoding = path, start, end, first, encoding


class Ranges(InputPartition):
    """What one task reads, range by range."""

    def __init__(self, ranges: list[Range]):
        self.ranges = ranges


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("/", "file:")) else (fs.LocalFileSystem(), path)


def _files(path: str) -> Iterator[tuple[str, int]]:
    """(path, size) of a file, or of the files in a folder that are no marks or hidden ones."""
    system, inner = _open(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    found = system.get_file_info(inner)
    if found.type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    else:
        found = [found]
    for info in sorted(found, key=lambda i: i.path):
        if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
            yield prefix + info.path, info.size


def ranges(path: str, encoding: str, size: int) -> list[Range]:
    """Ranges of whole code units over all files; a byte order mark decides for its file and is no text."""
    out = []
    for name, total in _files(path):
        system, inner = _open(name)
        with system.open_input_file(inner) as file:
            mark = file.read_at(2, 0) if total >= 2 else b""
        first = 2 if mark in _MARKS else 0
        own = _MARKS.get(mark, encoding)
        step = max(2, size - size % 2)
        out += [Range(name, at, min(total, at + step), first, own) for at in range(first, total, step)]
    return out


def dealt(found: list[Range]) -> list[Ranges]:
    """Neighbouring ranges put together: a start of a task costs more than a short range, so tasks grow with bytes, not with ranges."""
    room = min(TASK_BYTES, sum(r.end - r.start for r in found) // TASKS)
    out: list[Ranges] = []
    held = 0
    for part in found:
        if not out or held + part.end - part.start > room:
            out.append(Ranges([]))
            held = 0
        out[-1].ranges.append(part)
        held += part.end - part.start
    return out


def _line_end(data: bytes, mark: bytes, at: int) -> int:
    """Where the next line end begins in whole code units from an even place on, or -1."""
    at = data.find(mark, at)
    while at > 0 and at % 2:
        at = data.find(mark, at + 1)
    return at


def lines(part: Range) -> Iterator[str]:
    """The lines that begin in a range."""
    mark = "\n".encode(part.encoding)
    system, inner = _open(part.path)
    with system.open_input_file(inner) as file:
        at = part.start
        held = b""
        skip = at > part.first  # a line begins here only if the unit before ends one
        if skip:
            at -= 2
        file.seek(at)
        begin = at  # where the line in `held` begins
        while True:
            more = file.read(min(CHUNK, max(MORE, part.end - at, len(held))))
            at += len(more)
            searched = max(0, len(held) - len(held) % 2 - 2)
            held += more
            cut = 0
            end = _line_end(held, mark, searched)
            while end >= 0:
                if skip:
                    skip = False
                elif begin + cut >= part.end:
                    return
                else:
                    yield held[cut:end].decode(part.encoding).removesuffix("\r")
                cut = end + 2
                end = _line_end(held, mark, cut)
            if skip:  # of a line that began before, only the last unit matters
                cut = max(0, len(held) - len(held) % 2 - 2)
            held, begin = held[cut:], begin + cut
            if skip and not more:
                return
            if begin >= part.end and not skip:
                return
            if not more:
                if held:
                    yield held.decode(part.encoding, "replace").removesuffix("\r")
                return


class Utf16Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.encoding = options["path"], options.get("encoding", "utf-16-le")
        self.size = int(options.get("rangebytes", RANGE))

    def partitions(self) -> Sequence[InputPartition]:
        return dealt(ranges(self.path, self.encoding, self.size)) or [Ranges([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for line in (line for part in partition.ranges for line in lines(part)):
            held.append(line)
            if len(held) == LINES:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])


class Utf16Lines(DataSource):
    """Format `utf16_lines`: options path, encoding (where a file has no mark) and rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "utf16_lines"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return Utf16Reader({k.lower(): v for k, v in self.options.items()})


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-16", range_bytes: int = RANGE) -> DataFrame:
    """(value): the lines of a file or folder in UTF-16; without a mark or a byte order in `encoding`, little-endian."""
    ship(spark)
    spark.dataSource.register(Utf16Lines)
    order = "utf-16-be" if encoding.upper().replace("_", "-").endswith("BE") else "utf-16-le"
    return spark.read.format("utf16_lines").option("encoding", order).option("rangeBytes", str(range_bytes)).load(path)
