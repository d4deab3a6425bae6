"""Numbered commits: a log of small files that concurrent writers cannot both create.

Commit ``n`` is the file ``<n>.json`` of a log, rows as JSON lines. Its name is taken exclusively and its
content is complete before it can be seen, so of two writers that saw the same last commit one gets the next
number and the other is told; what is lost to it is its choice. A commit holds only what it changes, and
Spark reads the log as a table.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.session import local_path

_DIGITS = 12


def commit(spark: SparkSession, log: str, number: int, rows: Iterable[Mapping]) -> bool:
    """Add commit ``number``; False if another writer has it."""
    lines = "".join(json.dumps(row, default=str) + "\n" for row in rows)
    return create_new(spark, f"{log}/{number:0{_DIGITS}d}.json", lines)


def read_commits(spark: SparkSession, log: str, schema: str) -> DataFrame:
    """Rows of all commits with their ``number``; none before the first."""
    spark.createDataFrame([], schema).write.mode("ignore").json(log)
    rows = spark.read.schema(schema).json(log)
    number = F.regexp_extract("_metadata.file_name", r"^(\d+)\.json$", 1)
    # Spark's own part files, of creating the log, have no rows.
    return rows.select("*", F.try_to_number(number, F.lit("9" * _DIGITS)).cast("bigint").alias("number"))


def create_new(spark: SparkSession, path: str, text: str, hadoop: bool = False) -> bool:
    """Create a file with its whole content at once; False if there is one already.

    In a local folder a link does it. Elsewhere it is a rename that must not replace, which is one step
    on HDFS and stores with conditional writes; a store without these must see one run at a time.
    """
    local = None if hadoop else local_path(path)
    if local is None:
        return _create_by_rename(spark, path, text)
    folder = os.path.dirname(local)
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as file:
        file.write(text)
    try:
        os.link(draft, local)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)


def _create_by_rename(spark: SparkSession, path: str, text: str) -> bool:
    from py4j.protocol import Py4JJavaError

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    draft = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    keep = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    keep[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(files.makeQualified(target).toUri(), conf).rename(draft, target, keep)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(draft, False)
