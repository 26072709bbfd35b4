"""Text files, one for each document, all in one directory."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from partflow.sources.storage import Storage

#: How Spark spells a null key in a path.
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def write_documents(rows: DataFrame, root: str) -> None:
    """Write a text file below ``root`` (new) for each key, the first of the two columns, with its texts as lines.

    Keys are numbers or text that can stand in a file name; null is one of them. On a
    local or mounted folder tasks write ``<column>=<key>.txt`` themselves: Hadoop's local
    file system starts a process for each permission it sets, several for a file. A file
    gets its name when it is whole, and a task that is tried again writes the same ones.
    Elsewhere Spark's writer makes a directory ``<column>=<key>`` for each.
    """
    key, _ = rows.columns
    storage = Storage(rows.sparkSession)
    place = storage.qualified(root)
    if not place.startswith("file:"):
        rows.repartition(key).write.partitionBy(key).text(root)
        return
    folder = "/" + place.removeprefix("file:").lstrip("/")
    storage.make_directory(root)

    def write(partition: Iterator[Row]) -> None:
        for name, lines in groupby(partition, key=lambda row: row[0]):
            path = f"{folder}/{key}={_NO_KEY if name is None else name}.txt"
            part = f"{folder}/_{uuid.uuid4().hex}"  # readers leave out names that begin so
            with open(part, "w", encoding="utf-8", newline="") as file:
                file.writelines(f"{row[1] or ''}\n" for row in lines)
            os.replace(part, path)

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    rows.repartition(tasks, key).sortWithinPartitions(*rows.columns).foreachPartition(write)
