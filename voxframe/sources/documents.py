"""Single documents (JSON, star files) of many rows, written by tasks and put together when all of them are done."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: the number of its partition, its file and rows."""

    partition: int
    path: str
    rows: int


class DocumentWriter(DataSourceWriter):
    """A task writes its rows' texts to a file of its own; the commit joins the files in the order of the partitions.

    Files of failed or repeated attempts aren't in the commit's messages, and go with the folder of the parts. The document takes the
    place of an older one only when it is whole. Tasks and driver must see the document's folder.
    """

    def __init__(self, options: dict):
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        self.head, self.between, self.tail = (options.get(k, "") for k in ("head", "between", "tail"))
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"
        os.makedirs(self.parts)  # once, on the driver: tasks that still run after an abort find no folder

    def write(self, rows: Iterator) -> Part:
        partition, n = TaskContext.get().partitionId(), 0
        path = f"{self.parts}/{partition}-{uuid.uuid4().hex}"
        with open(path, "w", encoding="utf-8", newline="") as file:
            for (text,) in rows:
                file.write(f"{self.between if n else ''}{text}")
                n += 1
        return Part(partition, path, n)

    def commit(self, messages: list[Part | None]) -> None:
        whole = f"{self.path}.{uuid.uuid4().hex}"
        filled = sorted((m for m in messages if m and m.rows), key=lambda m: m.partition)
        with open(whole, "wb") as file:
            file.write(self.head.encode())
            for k, part in enumerate(filled):
                if k:
                    file.write(self.between.encode())
                with open(part.path, "rb") as own:
                    shutil.copyfileobj(own, file, 1 << 20)
            file.write(self.tail.encode())
        os.replace(whole, self.path)
        shutil.rmtree(self.parts, ignore_errors=True)

    def abort(self, messages: list[Part | None]) -> None:
        os.rename(self.parts, gone := f"{self.parts}.gone")
        shutil.rmtree(gone, ignore_errors=True)


class DocumentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "document"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options)


def put_document(df: DataFrame, text: Column, path: str, head: str = "", between: str = "\n", tail: str = "\n") -> None:
    """head, the text of each row with `between` in between, tail; rows in the frame's order. No row comes to the driver."""
    df.sparkSession.dataSource.register(DocumentSource)
    texts = df.select(text.alias("value"))
    texts.write.format("document").mode("overwrite").option("head", head).option("between", between).option("tail", tail).save(path)


def as_json(df: DataFrame) -> Column:
    """A row as a JSON object, with its nulls."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
