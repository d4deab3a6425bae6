"""Hard negatives of anchors, by best-first search of packed R-trees.

Rows are integer vectors with a label; a row's score is its inner product with the anchor. An anchor's
positives are the rows of its label with the highest scores. For each positive, the negatives are the
rows of other labels with the highest scores in a window that the positive's score opens: near enough
to be hard, far enough not to be a missed positive.

Rows are dealt into blocks of bounded size. A task packs the rows of a block into an R-tree by
sort-tile-recursive: sorted by the coordinate that spreads most, cut into slabs, each slab by the next
coordinate, and so on; runs of leaves become nodes. A node's minimum bounding box gives the interval
of each coordinate, and with the anchor the least and the greatest inner product that a row in it can
have. A search takes nodes from a queue, greatest bound first, and leaves out boxes outside the window
and those with a bound strictly below the score of the k-th row found: at equal scores a smaller id may
still come. Some anchors search together, so that a box is taken from the queue once and compared with
those that it still concerns. The best rows of all blocks are then ranked together. All anchors meet all
blocks; rows that are compared are never emitted, only the best of a block.

Rows with a NULL label or vector or a NULL component take no part, and neither anchors nor rows
compare with vectors of another length. Repeated rows are rows of their own; ties go to the smaller
id, NULL last, then to any. Scores are exact; beyond 64 bits they are cut to the range of BIGINT.
Empty tables, and anchors without positives or negatives, give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch

POSITIVES, NEGATIVES = 5, 3
#: The window in hundredths of the positive's score.
LOW, HIGH = 50, 95
#: Rows of a block, of a leaf, and nodes below a node.
BLOCK_ROWS, LEAF_ROWS, FAN_OUT = 8192, 64, 8
#: Anchors that search together.
ANCHORS_AT_ONCE = 256
_LONG = 2**63


@dataclass
class Tree:
    """An R-tree over the rows of a block; leaves come first, the root last."""

    rows: dict  # number, id, label (as a number) and vector of each row, in the order of the leaves
    low: np.ndarray  # nodes x coordinates
    high: np.ndarray
    first: np.ndarray  # first row of a leaf, first child of another node
    after: np.ndarray
    leaves: int
    scored: int = 0  # (anchor, row) that were compared

    @classmethod
    def pack(cls, rows: dict) -> Tree:
        vector = rows["vector"]
        order = np.concatenate(_tiles(vector))
        rows = {name: values[order] for name, values in rows.items()}
        vector = rows["vector"]
        first = np.arange(0, len(vector), LEAF_ROWS)
        after = np.minimum(first + LEAF_ROWS, len(vector))
        low, high = (f.reduceat(vector, first, axis=0) for f in (np.minimum, np.maximum))
        lows, highs, firsts, afters = [low], [high], [first], [after]
        begin = 0
        while len(low) > 1:
            cut = np.arange(0, len(low), FAN_OUT)
            firsts.append(begin + cut)
            afters.append(begin + np.minimum(cut + FAN_OUT, len(low)))
            begin += len(low)
            low, high = np.minimum.reduceat(low, cut, axis=0), np.maximum.reduceat(high, cut, axis=0)
            lows.append(low)
            highs.append(high)
        return cls(rows, *(np.concatenate(p) for p in (lows, highs, firsts, afters)), len(first))

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with any row of each node."""
        plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return plus @ self.low.T + minus @ self.high.T, plus @ self.high.T + minus @ self.low.T

    def best(self, anchors: dict, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> Best:
        """The ``k`` best rows of each window (anchors x windows, from ``low`` to ``high``) among rows of
        the anchor's label, itself left out, or of other labels."""
        least, most = self.bounds(anchors["vector"])
        found = Best.none((*low.shape, k), least.dtype)
        root = len(self.first) - 1
        queue = [(0, root)]
        while queue:
            node = heapq.heappop(queue)[1]
            reach = np.minimum(most[:, node, None], high)
            asks = (reach >= low) & (least[:, node, None] <= high) & (reach >= found.score[:, :, -1])
            some = np.nonzero(asks.any(axis=1))[0]
            if not len(some):
                continue
            place = slice(self.first[node], self.after[node])
            if node >= self.leaves:
                bound = np.minimum(most[some, place].max(axis=0), high[some][asks[some]].max())
                for child, at in zip(range(place.start, place.stop), bound):
                    heapq.heappush(queue, (-at, child))
                continue
            self.scored += len(some) * (place.stop - place.start)
            rows = {name: values[place] for name, values in self.rows.items()}
            score = anchors["vector"][some] @ rows["vector"].T
            fits = (anchors["label"][some, None] == rows["label"]) == same
            fits &= anchors["number"][some, None] != rows["number"]
            wide = score[:, None, :]
            good = fits[:, None, :] & (wide >= np.maximum(low[some], found.score[some, :, -1])[:, :, None])
            good &= wide <= high[some][:, :, None]
            a, w = np.nonzero(good.any(axis=2))
            if len(a):
                found.merge(some[a], w, np.where(good[a, w], score[a], -np.inf), rows["id"], rows["number"])
        return found


@dataclass
class Best:
    """The best rows so far, (anchors x windows x k), best first; a score of minus infinity: none."""

    score: np.ndarray
    id: np.ndarray
    number: np.ndarray

    @classmethod
    def none(cls, shape: tuple, kind: np.dtype) -> Best:
        return cls(np.full(shape, -np.inf, kind), np.full(shape, _LONG - 1), np.full(shape, -1))

    def merge(self, a: np.ndarray, w: np.ndarray, score: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        """Add the rows of a leaf (windows x rows) to the windows (``a``, ``w``)."""
        score = np.concatenate([self.score[a, w], score], axis=1)
        ids, numbers = (
            np.concatenate([own[a, w], np.broadcast_to(new, (len(a), len(new)))], axis=1)
            for own, new in ((self.id, ids), (self.number, numbers))
        )
        order = np.argsort(numbers, axis=1, kind="stable")
        for key in (ids, -score):
            by = np.argsort(np.take_along_axis(key, order, axis=1), axis=1, kind="stable")
            order = np.take_along_axis(order, by, axis=1)
        order = order[:, : self.score.shape[2]]
        for own, new in ((self.score, score), (self.id, ids), (self.number, numbers)):
            own[a, w] = np.take_along_axis(new, order, axis=1)


def _tiles(vector: np.ndarray) -> list[np.ndarray]:
    """Rows in the order of sort-tile-recursive, as the slabs of its last round."""
    leaves = -(-len(vector) // LEAF_ROWS)
    spread = vector.astype(np.float64).std(axis=0)
    rounds = min(len(spread), max(1, int(np.ceil(np.log2(leaves))))) if leaves > 1 else 0
    parts = [np.arange(len(vector))]
    for left, axis in zip(range(rounds, 0, -1), np.argsort(-spread, kind="stable")):
        cut = []
        for part in parts:
            here = -(-len(part) // LEAF_ROWS)
            slabs = int(np.ceil(here ** (1 / left) - 1e-9))
            rows = -(-here // slabs) * LEAF_ROWS  # whole leaves
            part = part[np.argsort(vector[part, axis], kind="stable")]
            cut += [part[i: i + rows] for i in range(0, len(part), rows)]
        parts = cut
    return parts


def _exact(vectors: list[np.ndarray]) -> np.dtype:
    """Doubles where all sums of products stay below 2^53, else Python's integers."""
    if not vectors[0].shape[1]:
        return np.float64
    largest = [max(abs(int(v.min(initial=0))), abs(int(v.max(initial=0)))) for v in vectors]
    return np.float64 if largest[0] * largest[1] * vectors[0].shape[1] < 2**53 else object


def _side(rows: pa.Table, size: int) -> dict:
    ids = rows.column("id").combine_chunks()
    flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return {
        "number": rows.column("number").to_numpy(), "label": rows.column("label").to_numpy(),
        "id": ids.fill_null(_LONG - 1).to_numpy(zero_copy_only=False),
        "vector": flat.astype(np.int64).reshape(rows.num_rows, size),
    }


_KEYS = ("size", "part", "block")
_MEMBER = [*_KEYS, "query", "number", "id", "label", "vector", "scores", "ids"]


def _search(same: bool, k: int, low: int, high: int):
    """Search of the blocks of a task: the rows of a block come first, then the anchors that meet it.

    An anchor has one window for each of its ``scores``, or takes all scores if it has none yet.
    """

    def windows(scores: list, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """From and to which score; an anchor with fewer positives than others has empty windows."""
        count = max((len(s) for s in scores if s is not None), default=1)
        every = [[(-np.inf, np.inf)] if s is None else [(-(-low * p // 100), high * p // 100) for p in s] for s in scores]
        ends = [[*own, *[(np.inf, -np.inf)] * (count - len(own))] for own in every]
        return tuple(np.array([[w[side] for w in own] for own in ends], kind) for side in (0, 1))

    def answers(tree: Tree, anchors: dict, rows: pa.Table) -> pa.RecordBatch:
        scores, ids, own = (rows.column(c).to_pylist() for c in ("scores", "ids", "id"))
        begin, end = windows(scores, anchors["vector"].dtype)
        found = tree.best(anchors, begin, end, k, same)
        some = np.nonzero(found.score > -np.inf)
        row, slot = some[0].tolist(), some[1].tolist()
        known = [scores[r] is not None for r in row]
        columns = [
            anchors["number"][some[0]], [own[r] for r in row], slot,
            [ids[r][w] if there else None for r, w, there in zip(row, slot, known)],
            [scores[r][w] if there else None for r, w, there in zip(row, slot, known)],
            [None if i == _LONG - 1 else i for i in found.id[some].tolist()], found.number[some],
            [max(-_LONG, min(_LONG - 1, int(x))) for x in found.score[some].tolist()],
        ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _ANSWER)

    def searched(tree: Tree, block: dict, names: dict, rows: pa.Table, size: int) -> Iterator[pa.RecordBatch]:
        for begin in range(0, rows.num_rows, ANCHORS_AT_ONCE):
            some = rows.slice(begin, ANCHORS_AT_ONCE)
            anchors = _side(some, size)
            anchors["label"] = np.array([names.get(label, -1) for label in anchors["label"]])
            if _exact([block["vector"], anchors["vector"]]) is object:
                anchors["vector"] = anchors["vector"].astype(object)
                yield answers(Tree.pack({**block, "vector": block["vector"].astype(object)}), anchors, some)
            else:
                anchors["vector"] = anchors["vector"].astype(np.float64)
                yield answers(tree, anchors, some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block, tree, names = None, [], None, None, {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
            turns = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)] if keys else []
            for begin, end in zip(turns, turns[1:]):
                rows, here = table.slice(begin, end - begin), keys[begin]
                if here[:3] != key:
                    key, held, tree = here[:3], [], None
                if here[3] == 0:
                    held.append(_side(rows, here[0]))
                elif held or tree:  # else the hash has dealt this block no rows
                    if tree is None:
                        block = {n: np.concatenate([h[n] for h in held]) for n in held[0]}
                        found, block["label"] = np.unique(block["label"], return_inverse=True)
                        names = {label: code for code, label in enumerate(found.tolist())}
                        tree, held = Tree.pack({**block, "vector": block["vector"].astype(np.float64)}), []
                    yield from searched(tree, block, names, rows, here[0])

    return run


_ANSWER = ["anchor", "anchor_id", "slot", "positive_id", "positive_score", "found_id", "found", "score"]
_ANSWER_TYPES = (
    "anchor long, anchor_id long, slot int, positive_id long, positive_score long, "
    "found_id long, found long, score long"
)


def _meet(rows: DataFrame, anchors: DataFrame, parts: list[str], search) -> DataFrame:
    """The answers of all anchors in all blocks that have their ``parts``."""
    sizes = rows.groupBy(*parts).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")
    )
    nothing = F.lit(None).cast("array<long>")
    part = (F.col("label") if "label" in parts else F.lit("")).alias("part")
    members = rows.join(sizes, parts).select(
        "size", part, F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int").alias("block"),
        F.lit(0).alias("query"), "number", "id", "label", "vector", nothing.alias("scores"), nothing.alias("ids"),
    )
    visits = anchors.join(sizes, parts).select(
        "size", part, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("query"), "number", "id", "label", "vector", "scores", "ids",
    )
    dealt = members.unionByName(visits).select(*_MEMBER).repartition(*_KEYS)
    return dealt.sortWithinPartitions(*_KEYS, "query").mapInArrow(search, _ANSWER_TYPES)


def _best(answers: DataFrame, by: list[str], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("found_id").asc_nulls_last(), F.col("found")]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return answers.withColumn("place", place).where(F.col("place") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: (vec_id BIGINT, label, vector ARRAY<BIGINT>); ``is_anchor``: a condition on them.
    """
    scratch = Scratch(rows.sparkSession, "negatives")
    whole = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    taken, _ = scratch.write(rows.where(whole).select(
        F.monotonically_increasing_id().alias("number"), F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("string").alias("label"), "vector", F.size("vector").alias("size"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ))
    nothing = F.lit(None).cast("array<long>")
    anchors = taken.where("is_anchor").drop("is_anchor")
    members = taken.drop("is_anchor")
    first = anchors.withColumn("scores", nothing).withColumn("ids", nothing)
    near, _ = scratch.write(_meet(members, first, ["size", "label"], _search(True, positives, low, high)))
    lists = _best(near, ["anchor"], positives).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("place", "score", "found_id"))).alias("found")
    )
    asked, _ = scratch.write(anchors.join(lists, F.col("number") == F.col("anchor")).select(
        "number", "id", "label", "vector", "size", F.col("found.score").alias("scores"), F.col("found.found_id").alias("ids"),
    ))
    far, _ = scratch.write(_meet(members, asked, ["size"], _search(False, negatives, low, high)))
    return _best(far, ["anchor", "slot"], negatives).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def as_integers(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) of (vec_id, label, embedding): each component times ``scale``, floored.
    Rows with a non-finite component lose their vector."""
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return rows.select("vec_id", "label", F.when(finite, scaled).alias("vector"))
