"""Near-duplicate vectors by product quantisation.

Vectors of one label link when their cosine, in double precision, reaches the threshold. Equal vectors
of a label are one class from the start, with a weight. For the rest, an index:

* A coarse quantiser deals unit vectors into inverted lists; each is kept as its list and the codes of
  its residual in every subspace, together with the exact length of the coding error.
* A pair in two lists lies on both sides of the plane between their centres. The distances of the two to
  it add up to the part of their difference along its normal, so one of them is within half of that:
  whoever is near the plane visits the other's list. That part is at most the radius that the threshold
  means, but in many dimensions a difference has little of its length in any one direction. The plane's
  reach is therefore ``SPREADS`` times the standard deviation to expect there, from the spread of the
  vectors around their centres, and never above half the radius. ``spreads=None`` takes half the radius
  for every plane, which loses nothing and in many dimensions visits most lists.
* Members carry the lists that they visit, so a pair that both sides would find counts from one of them.
* In a list, distances are summed from a table of the query's distances to the codewords. A member
  stays a candidate while that distance, less its coding error, is within the radius; the triangle
  inequality makes this lossless. Candidates are compared by exact cosine.

Codebooks are trained on a bounded sample (``SAMPLE``); every vector is indexed and searched. Lists
are dealt into blocks of bounded size, and a block's queries stream past it, so no task holds a list.
A task returns counts for each vector and a spanning forest of the links, never the pairs.

Vectors that are NULL, empty or zero, or hold NULL or non-finite components, and those without a
label link with nothing; so do vectors of different lengths. Equal rows link. A NULL vec_id is never
kept and never names a component unless all ids in it are NULL. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch, components, least_reached

THRESHOLD = 0.93
#: Vectors on which the codebooks are trained, at most.
SAMPLE = 16_384
#: Mean length of an inverted list, as far as the sample allows for so many lists.
LIST_ROWS, MOST_LISTS = 512, 1024
SUBSPACES, CODEWORDS = 8, 256
#: Members of a block and queries that are compared with it at once.
BLOCK_ROWS, QUERY_ROWS = 1024, 512
ROUNDS = 8
#: A vector visits a list when the plane between is this many standard deviations away, at most. A pair
#: gets lost only if its difference has twice as many along the normal: three pairs in 100,000 of those
#: at the threshold itself whose ends are in two lists, fewer of closer ones.
SPREADS = 2.0


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _k_means(points: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from random points; centres that lose all points stay."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), count, replace=len(points) < count)].copy()
    for _ in range(ROUNDS):
        owner = _nearest(points, centres)
        sums, sizes = np.zeros_like(centres), np.bincount(owner, minlength=count)
        np.add.at(sums, owner, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


@dataclass
class ProductIndex:
    """Codebooks over unit vectors, filled up with zeros to a multiple of the subspaces."""

    width: int
    radius: float
    centres: np.ndarray  # lists x width
    codewords: np.ndarray  # subspaces x codewords x width / subspaces
    spread: np.ndarray | None  # width x width, trace 1: where differences go; None: visit all that can hold one
    spreads: float

    @classmethod
    def fit(
        cls, units: np.ndarray, lists: int, threshold: float, spreads: float | None = SPREADS
    ) -> ProductIndex:
        width = units.shape[1]
        centres = _k_means(units, lists, 1)
        residual = units - centres[_nearest(units, centres)]
        parts = residual.reshape(len(units), SUBSPACES, -1)
        count = min(CODEWORDS, max(1, len(units) // 4))
        words = np.stack([_k_means(np.ascontiguousarray(parts[:, s]), count, 2 + s) for s in range(SUBSPACES)])
        # A little slack for rounding; the exact comparison decides.
        radius, spread = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6, None
        if spreads is not None:
            spread = residual.T @ residual
            spread /= max(np.trace(spread), 1e-12)
        return cls(width, radius, centres, words, spread, spreads or 0.0)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of each vector."""
        lists = _nearest(units, self.centres)
        parts = (units - self.centres[lists]).reshape(len(units), SUBSPACES, -1)
        codes = np.stack([
            _nearest(parts[:, s], self.codewords[s]) for s in range(SUBSPACES)
        ], axis=1)
        rest = np.stack([parts[:, s] - self.codewords[s][codes[:, s]] for s in range(SUBSPACES)], axis=1)
        return lists, codes.astype(np.uint8), np.sqrt((rest * rest).sum(axis=(1, 2)))

    def probes(self, units: np.ndarray, lists: np.ndarray) -> list[np.ndarray]:
        """For each vector the lists that it visits: its own and those whose plane it is near to."""
        lengths = (self.centres * self.centres).sum(axis=1)
        apart = np.sqrt(np.maximum(0, lengths[:, None] + lengths - 2 * self.centres @ self.centres.T))
        reach = np.full_like(apart, self.radius / 2)
        if self.spread is not None:
            along = self.centres @ self.spread @ self.centres.T
            own = np.diagonal(along)
            share = (own[:, None] + own - 2 * along) / np.maximum(apart * apart, 1e-12)
            # Differences that are alike in all directions have this much in each.
            share = np.maximum(share, 1 / self.width)
            reach = np.minimum(reach, self.spreads * self.radius * np.sqrt(share))
        square = lengths - 2 * units @ self.centres.T
        beyond = square - square[np.arange(len(units)), lists][:, None]
        near = beyond <= (2 * reach * apart + 1e-6)[lists]
        near[np.arange(len(units)), lists] = True
        return [np.nonzero(n)[0] for n in near]

    def candidates(
        self, queries: np.ndarray, centre: int, codes: np.ndarray, error: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) that may be within the radius, by tables of distances to codewords."""
        parts = (queries - self.centres[centre]).reshape(len(queries), SUBSPACES, -1)
        square = np.zeros((len(queries), len(codes)), np.float64)
        for s in range(SUBSPACES):
            words = self.codewords[s]
            table = (
                (parts[:, s] ** 2).sum(axis=1)[:, None] + (words * words).sum(axis=1)
                - 2 * parts[:, s] @ words.T
            )
            square += table[:, codes[:, s]]
        return np.nonzero(np.sqrt(np.maximum(square, 0)) <= self.radius + error + 1e-6)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column in double precision, filled up with zeros to ``width``."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _compare(index: ProductIndex, centre: int, members: dict, queries: dict, threshold: float):
    """Counts (class, links) and forest (class, class) of the links between queries and members."""
    q, m = index.candidates(queries["unit"], centre, members["codes"], members["error"])
    # In the own list a pair counts from its smaller class; else, where the member visits the query's
    # list as well, from the smaller list.
    asks, lists = queries["list"][q], len(index.centres)
    mutual = np.isin(m * lists + asks, members["visits"])
    once = np.where(asks == centre, queries["class"][q] < members["class"][m], ~mutual | (asks < centre))
    q, m = q[once], m[once]
    keep = []
    for first in range(0, len(q), 1 << 16):
        some = slice(first, first + (1 << 16))
        x, y = queries["vector"][q[some]], members["vector"][m[some]]
        cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((y * y).sum(axis=1))
        keep.append(cosine >= threshold)
    if keep:
        linked = np.concatenate(keep)
        q, m = q[linked], m[linked]
    names = np.concatenate([queries["class"], members["class"]])
    links = np.concatenate([
        np.bincount(q, members["weight"][m], minlength=len(queries["class"])),
        np.bincount(m, queries["weight"][q], minlength=len(members["class"])),
    ]).astype(np.int64)
    some = np.nonzero(links)[0]
    nodes, root = least_reached(queries["class"][q], members["class"][m])
    return names[some], links[some], root[np.searchsorted(nodes, names[some])]


def _links(classes: DataFrame, index: ProductIndex, threshold: float) -> DataFrame:
    """(class, links, root): parts of each class's number of links, and a link of a forest."""
    kinds = "part long, list int, class long, weight long, vector array<float>"
    kinds += ", codes binary, error double, probes array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(_matrix(batch.column(3), index.width))
            lists, codes, error = index.encode(units)
            probes = index.probes(units, lists)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(lists, pa.int32()), *batch.columns[1:4],
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                pa.array(probes, pa.list_(pa.int32())),
            ], ["part", "list", "class", "weight", "vector", "codes", "error", "probes"])

    scratch = Scratch(classes.sparkSession, "vector-index")
    coded, _ = scratch.write(
        classes.select("part", "class", "weight", "vector").mapInArrow(encode, kinds)
    )
    sizes = coded.groupBy("part", "list").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")
    )
    members = coded.join(sizes, ["part", "list"]).select(
        "part", F.col("list").alias("visited"),
        F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"),
        F.lit(0).alias("query"), "list", "class", "weight", "vector", "codes", "error", "probes",
    )
    visits = coded.select(
        "part", F.explode("probes").alias("visited"), "list", "class", "weight", "vector"
    )
    visited = sizes.withColumnRenamed("list", "visited")
    queries = visits.join(visited, ["part", "visited"]).select(
        "part", "visited", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("query"), "list", "class", "weight", "vector",
        F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"),
        F.lit(None).cast("array<int>").alias("probes"),
    )
    names = [
        "part", "visited", "block", "query", "list", "class", "weight", "vector", "codes", "error", "probes",
    ]

    def side(rows: pa.Table) -> dict:
        vector = _matrix(rows.column("vector").combine_chunks(), index.width)
        found = {"vector": vector, "unit": _units(vector)}
        for name in ("class", "weight", "list"):
            found[name] = rows.column(name).to_numpy()
        return found

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members = None, None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
            turn = np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1
            bounds = [0, *turn.tolist(), batch.num_rows] if batch.num_rows else []
            for low, high in zip(bounds, bounds[1:]):
                rows, key = pa.Table.from_batches([batch.slice(low, high - low)]), tuple(keys[:3, low])
                if keys[3, low] == 0:  # members come before the queries of their block
                    held = side(rows)
                    held["codes"] = np.frombuffer(
                        b"".join(rows.column("codes").to_pylist()), np.uint8
                    ).reshape(-1, SUBSPACES)
                    held["error"] = rows.column("error").to_numpy()
                    before = len(members["class"]) if block == key else 0
                    probes = rows.column("probes").combine_chunks()
                    place = np.repeat(np.arange(rows.num_rows) + before, probes.value_lengths().to_numpy())
                    held["visits"] = place * len(index.centres) + probes.flatten().to_numpy()
                    if block == key:
                        held = {k: np.concatenate([members[k], v]) for k, v in held.items()}
                    block, members = key, held
                    continue
                if block != key:  # the hash has dealt this block no members
                    continue
                for first in range(0, rows.num_rows, QUERY_ROWS):
                    found = _compare(
                        index, int(key[1]), members, side(rows.slice(first, QUERY_ROWS)), threshold
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in found], ["class", "links", "root"]
                    )

    keys = ["part", "visited", "block"]
    return (
        members.unionByName(queries).select(*names).repartition(*keys)
        .sortWithinPartitions(*keys, "query").mapInArrow(search, "class long, links long, root long")
    )


def near_duplicates(
    rows: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, spreads: float | None = SPREADS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label)."""
    scratch = Scratch(rows.sparkSession, "vectors")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    taken, _ = scratch.write(
        rows.select("vec_id", "embedding", "label", F.coalesce(usable, F.lit(False)).alias("usable"))
    )
    vectors = taken.where("usable").select(
        "vec_id", F.xxhash64("label", F.size("embedding")).alias("part"), "label",
        F.col("embedding").alias("vector"),
    )
    grouped = vectors.groupBy("label", "part", "vector").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
    )
    classes, _ = scratch.write(grouped.withColumn("class", F.monotonically_increasing_id()))
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    alone = taken.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if not size["n"]:
        return alone.withColumn("kept", F.col("vec_id").isNotNull())

    width = -(-size["width"] // SUBSPACES) * SUBSPACES
    order = [F.xxhash64("vector"), F.col("class")]
    drawn = classes.select("vector", "class").orderBy(*order).limit(sample).select("vector").toArrow()
    units = _units(_matrix(drawn.column("vector").combine_chunks(), width))
    lists = min(max(1, size["n"] // LIST_ROWS), MOST_LISTS, max(1, len(units) // 16))
    index = ProductIndex.fit(units, lists, threshold, spreads)

    links, _ = scratch.write(_links(classes, index, threshold))
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    forest = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")), "vector-components")
    joined = (
        classes.join(counts, "class", "left")
        .join(forest, F.col("class") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    joined, _ = scratch.write(joined.select(
        "label", "part", "vector", "least", "component",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    ))
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class, _ = scratch.write(
        joined.join(named, "component").select("label", "part", "vector", "n_links", "component_id")
    )
    linked = vectors.join(of_class, ["label", "part", "vector"]).select("vec_id", "n_links", "component_id")
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
