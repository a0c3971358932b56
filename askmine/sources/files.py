"""Named text files as a Spark sink and source: what people read, and shards by name.

A sink takes rows (file, place, line); a file's lines are written in the order of their places by one task, under a name of
the attempt's own, and the commit gives the files of the tasks that count their names. So each file is whole or absent.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]{2,}:", path) else (fs.LocalFileSystem(), path)


@dataclass
class Moves(WriterCommitMessage):
    names: list[tuple[str, str]]


class LinesWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows: Iterator) -> Moves:
        system, folder = opened(self.folder)
        system.create_dir(folder, recursive=True)
        moves: list[tuple[str, str]] = []
        now, out = None, None
        try:
            for row in rows:
                if row["file"] != now:
                    if out is not None:
                        out.close()
                    now = row["file"]
                    part = f"{folder}/_{uuid.uuid4()}"
                    moves.append((part, f"{folder}/{now}"))
                    out = system.open_output_stream(part)
                out.write((row["line"] or "").encode("utf-8", "replace") + b"\n")
        finally:
            if out is not None:
                out.close()
        return Moves(moves)

    def commit(self, messages: list) -> None:
        system, _ = opened(self.folder)
        for message in messages:
            for part, name in message.names:
                system.move(part, name)

    def abort(self, messages: list) -> None:
        system, _ = opened(self.folder)
        for message in filter(None, messages):
            for part, _ in message.names:
                system.delete_file(part)


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_lines"

    def schema(self) -> str:
        return "file string, place bigint, line string"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options["path"])


def write_lines(rows: DataFrame, folder: str) -> None:
    """rows (file, place, line) as text files of these names in a folder; an older file of a name is replaced."""
    rows.sparkSession.dataSource.register(Lines)
    dealt = rows.select("file", F.col("place").cast("bigint"), "line").repartition("file").sortWithinPartitions("file", "place")
    dealt.write.format("named_lines").mode("append").save(folder)


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """path, text of every file below a folder, whole."""
    return spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
