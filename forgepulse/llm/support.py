"""Helpers that several operators share: tables, written intermediates, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.session import new_folder, remove, settle

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Edges that one task contracts to a forest, and rounds after which something must be wrong.
EDGES_A_TASK, MOST_ROUNDS = 500_000, 60
#: Longest run of rows whose texts are Python objects at the same time.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that few long texts are objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


class Scratch:
    """Written intermediates of one operator run; ``drop`` deletes those no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.count = spark, new_folder(spark, label), 0

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        self.count += 1
        path, conf = f"{self.folder}/{self.count}", self.spark.conf
        # What was shuffled for a table is not read again once the table is written.
        before = conf.get(_FREE_SHUFFLES, "false")
        conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.set(_FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path), path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) rows in both directions.

    Every node learns the least node beside it; the large step hangs its larger neighbours there,
    the small step itself and its smaller ones. A node with very many neighbours is a skewed join
    key, which adaptive execution splits, and a partial minimum.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    side = F.col("b") > F.col("a") if large else F.col("b") <= F.col("a")
    moved = both.where(side).join(least, "a").select(F.col("m").alias("a"), "b")
    if not large:
        own = least.select(F.col("m").alias("a"), F.col("a").alias("b"))
        moved = moved.unionAll(own)
    return (
        moved.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the links (a, b), and the least node that each is connected with."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a):]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[left], root[right])
        if (root[left] == least).all() and (root[right] == least).all():
            return nodes, nodes[root]
        for ends in (left, right):
            np.minimum.at(root, root[ends], least)
            np.minimum.at(root, ends, least)
        while (root[root] != root).any():
            root = root[root]


def _contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """A forest of stars in place of the edges of each task: what is connected stays so."""
    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            node, least = least_reached(rows.column("a").to_numpy(), rows.column("b").to_numpy())
            other = node != least
            yield pa.RecordBatch.from_arrays([pa.array(least[other]), pa.array(node[other])], ["a", "b"])

    return edges.select("a", "b").coalesce(tasks).mapInArrow(reach, "a long, b long")


def components(edges: DataFrame, label: str, edges_a_task: int = EDGES_A_TASK) -> DataFrame:
    """(node, component) for every node of the BIGINT edges (a, b); component: its least node.

    Tasks contract about ``edges_a_task`` edges each to forests. Large-star and small-star steps over
    these follow in turn until nothing moves; each round is a written table, so lineage stays short and
    no executor holds the only copy. Nodes without an edge to another do not appear.
    """
    scratch = Scratch(edges.sparkSession, label)
    given, given_path = scratch.write(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ))
    tasks = max(1, -(-given.count() // edges_a_task))
    current, path = scratch.write(_contracted(given, tasks))
    remove(given_path)
    digest = None
    for _ in range(MOST_ROUNDS):
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
        ).first()
        if (state["n"], state["x"]) == digest:
            break
        digest = (state["n"], state["x"])
        half, half_path = scratch.write(_star(current, large=True))
        after, after_path = scratch.write(_star(half, large=False))
        remove(path)
        remove(half_path)
        current, path = after, after_path
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def crc_of_id(column: str | Column) -> Column:
    """crc32 of an id written as text; rows without an id count as remainder of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


__all__ = [
    "ROWS_AT_ONCE", "Scratch", "components", "crc_of_id", "least_reached", "new_folder",
    "remove", "row_slices", "settle", "table",
]
