"""Topics kept as folders of JSON lines, read as a stream with offsets.

A topic's folder holds a folder ``partition=<n>`` per partition (or its files directly, which are partition 0), and
in it files whose names are in order of arrival. A message's offset is its line number over all of its
partition's files; files are only added, never changed. The reader keeps, per partition, the offset it has come
to with the file and the line in it, so that neither a restart nor a batch reads files it is done with.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# Tasks get this module's classes with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "value string, partition int, offset long"


def _files(path: str) -> dict[str, list[str]]:
    """Files of each partition in order, by any file system that pyarrow opens."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    found: dict[str, list[str]] = {}
    for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        inner = info.path.removeprefix(root).strip("/").split("/")
        if info.type != fs.FileType.File or any(part[0] in "_." for part in inner):
            continue
        folder = inner[0] if len(inner) > 1 else ""
        number = folder.partition("=")[2] if folder.startswith("partition=") else "0"
        found.setdefault(number, []).append(info.path)
    return {number: sorted(paths) for number, paths in found.items()}


def _lines(path: str, name: str) -> Iterator[str]:
    from pyarrow import fs

    store = fs.FileSystem.from_uri(path)[0] if "://" in path else fs.LocalFileSystem()
    with store.open_input_stream(name, compression="detect") as stream:
        rest = b""
        while block := stream.read(1 << 20):
            *whole, rest = (rest + block).split(b"\n")
            yield from (line.decode("utf-8") for line in whole)
        if rest:
            yield rest.decode("utf-8")


def _end_of(path: str, files: list[str], at: dict) -> dict:
    """The place behind the last line; only files that ``at`` has not passed are read."""
    place = dict(at)
    for name in files:
        if place["file"] and name < place["file"]:
            continue
        size = sum(1 for _ in _lines(path, name))
        done = place["line"] if name == place["file"] else 0
        place = {"offset": place["offset"] + size - done, "file": name, "line": size}
    return place


START = {"offset": 0, "file": "", "line": 0}


@dataclass
class Stretch(InputPartition):
    """Messages of one partition from one place to another."""

    number: int
    start: dict
    end: dict


class TopicReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting, self.known = path, starting, {}

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return {}
        if self.starting == "latest":
            return self.latestOffset()
        asked = json.loads(self.starting)
        return {str(number): self._place(str(number), int(offset)) for number, offset in asked.items()}

    def _place(self, number: str, offset: int) -> dict:
        """The place of an offset; beyond the end, the end."""
        place = dict(START)
        for name in _files(self.path).get(number, []):
            size = sum(1 for _ in _lines(self.path, name))
            if place["offset"] + size >= offset:
                return {"offset": offset, "file": name, "line": offset - place["offset"]}
            place = {"offset": place["offset"] + size, "file": name, "line": size}
        return place

    def latestOffset(self) -> dict:
        for number, files in _files(self.path).items():
            self.known[number] = _end_of(self.path, files, self.known.get(number, START))
        return json.loads(json.dumps(self.known))

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for number, last in end.items():
            first = start.get(number, START)
            self.known.setdefault(number, dict(last))
            if first["offset"] < last["offset"]:
                out.append(Stretch(int(number), first, last))
        return out

    def read(self, partition: Stretch) -> Iterator[tuple]:
        offset, end = partition.start["offset"], partition.end
        for name in _files(self.path).get(str(partition.number), []):
            if name < partition.start["file"] or name > end["file"]:
                continue
            skipped = partition.start["line"] if name == partition.start["file"] else 0
            for line, text in enumerate(_lines(self.path, name)):
                if line < skipped:
                    continue
                if offset >= end["offset"]:
                    return
                yield text, partition.number, offset
                offset += 1


class TopicSource(DataSource):
    """Options: ``path`` of the topic's folder, ``startingOffsets``."""

    @classmethod
    def name(cls) -> str:
        return "topic_folder"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> TopicReader:
        return TopicReader(self.options["path"], self.options.get("startingoffsets", "latest"))


def read_stream(spark: SparkSession, path: str, starting_offsets: str = "latest", **options: str) -> DataFrame:
    """``value``, ``partition``, ``offset`` of the messages of a topic's folder.

    ``starting_offsets``: ``earliest``, ``latest``, or JSON of offsets by partition, where partitions not named
    start at their beginning; so do partitions that appear later. A checkpoint that has offsets resumes at them."""
    spark.dataSource.register(TopicSource)
    reader = spark.readStream.format("topic_folder").option("path", path).option("startingOffsets", starting_offsets)
    return reader.options(**options).load()
