"""A partitioned log as a stream with offsets of its own, and a sink that acknowledges what it has.

The log is a folder of append-only files of lines, one per partition.  An offset is a position in bytes for each of them,
always behind a whole line; a partition's new lines are one task, which reads only its own span.  Lines carry how often
they were handed out: a span that is planned again, since its batch was not acknowledged, counts up.  The sink writes a
file per task and, once all of a batch are there, one manifest; only what manifests name counts, so a batch that is run
again replaces itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "partition string, position long, line string, deliveries int"
TAIL = 1 << 16


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _read_json(uri: str, name: str, default):
    from pyarrow import fs

    files, at = _fs(uri)
    if files.get_file_info(f"{at}/{name}").type == fs.FileType.NotFound:
        return default
    with files.open_input_stream(f"{at}/{name}") as src:
        return json.loads(src.read())


def _write_json(uri: str, name: str, value) -> None:
    """Under another name first, so a reader never sees half of it."""
    files, at = _fs(uri)
    files.create_dir(at, recursive=True)
    with files.open_output_stream(f"{at}/{name}.part") as out:
        out.write(json.dumps(value).encode())
    files.move(f"{at}/{name}.part", f"{at}/{name}")


@dataclass
class Span(InputPartition):
    name: str
    start: int
    end: int
    deliveries: int


class LogReader(DataSourceStreamReader):
    """Options: ``path`` (the log) and ``state`` (a folder for how often unacknowledged spans were planned)."""

    def __init__(self, options: dict):
        self.path, self.state = options["path"], options["state"]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Behind the last whole line of every partition; of a file only its tail is read."""
        from pyarrow import fs

        files, at = _fs(self.path)
        out = {}
        for info in files.get_file_info(fs.FileSelector(at)):
            if not info.is_file or info.base_name.startswith((".", "_")):
                continue
            end = info.size
            with files.open_input_file(info.path) as src:
                while end > 0:
                    begin = max(0, end - TAIL)
                    src.seek(begin)
                    last = src.read(end - begin).rfind(b"\n")
                    if last >= 0:
                        end = begin + last + 1
                        break
                    end = begin
            out[info.base_name] = end
        return dict(sorted(out.items()))

    def partitions(self, start: dict, end: dict) -> list[Span]:
        spans = [(n, start.get(n, 0), e) for n, e in end.items() if e > start.get(n, 0)]
        planned = _read_json(self.state, "planned.json", {})
        for n, s, _ in spans:
            planned[f"{n}:{s}"] = planned.get(f"{n}:{s}", 0) + 1
        _write_json(self.state, "planned.json", planned)
        return [Span(n, s, e, planned[f"{n}:{s}"]) for n, s, e in spans]

    def read(self, partition: Span) -> Iterator[tuple]:
        files, at = _fs(self.path)
        with files.open_input_file(f"{at}/{partition.name}") as src:
            src.seek(partition.start)
            position, rest = partition.start, b""
            while src.tell() < partition.end:
                *lines, rest = (rest + src.read(min(1 << 20, partition.end - src.tell()))).split(b"\n")
                for line in lines:
                    yield partition.name, position, line.decode("utf-8", "replace"), partition.deliveries
                    position += len(line) + 1

    def commit(self, end: dict) -> None:
        """What lies before ``end`` is acknowledged: its counts are forgotten."""
        planned = _read_json(self.state, "planned.json", {})
        kept = {k: n for k, n in planned.items() if int(k.rpartition(":")[2]) >= end.get(k.rpartition(":")[0], 0)}
        _write_json(self.state, "planned.json", kept)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class AckWriter(DataSourceStreamWriter):
    """Option ``path``: the folder of the rows' files and of a manifest per batch."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.names = options["path"], schema.fieldNames()

    def write(self, rows: Iterator) -> Written:
        import pyarrow as pa
        import pyarrow.parquet as pq

        held = [tuple(r) for r in rows]  # a task's share of a micro-batch
        if not held:
            return Written(None, 0)
        files, at = _fs(self.path)
        files.create_dir(at, recursive=True)
        name = f"rows-{uuid.uuid4().hex}.parquet"
        pq.write_table(pa.table(dict(zip(self.names, map(list, zip(*held, strict=True)), strict=True))), f"{at}/{name}", filesystem=files)
        return Written(name, len(held))

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        _write_json(self.path, f"batch-{batchId:012d}.json", {"files": [m.file for m in messages if m and m.file], "rows": sum(m.rows for m in messages if m)})

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        files, at = _fs(self.path)
        for m in messages:
            if m and m.file:
                files.delete_file(f"{at}/{m.file}")


class OffsetLog(DataSource):
    """``spark.readStream.format("offset_log")`` and ``writeStream.format("offset_log")``."""

    @classmethod
    def name(cls) -> str:
        return "offset_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> AckWriter:
        return AckWriter(dict(self.options), schema)


def lines(spark: SparkSession, path: str, state: str) -> DataFrame:
    """The log at ``path`` as a stream of (``partition``, ``position``, ``line``, ``deliveries``)."""
    spark.dataSource.register(OffsetLog)
    return spark.readStream.format("offset_log").option("path", path).option("state", state).load()


def acknowledged(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the sink at ``path`` has acknowledged: those of files that a manifest names."""
    files = spark.read.json(f"{path.rstrip('/')}/batch-*.json", schema="files array<string>, rows long").selectExpr("explode(files) AS file")
    rows = spark.read.parquet(*[f"{path.rstrip('/')}/rows-*.parquet"]).selectExpr("*", "element_at(split(_metadata.file_path, '/'), -1) AS __file")
    return rows.join(files, rows["__file"] == files["file"], "left_semi").drop("__file")
