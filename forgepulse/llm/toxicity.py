"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors: their terms are whole words and, beside each longer word, its
beginning as a term of its own, so that inflected and compounded forms have something in common. A term
counts by the logarithm of its frequency and by its rarity times how far its shares of toxic and of clean
examples differ (log odds, shrunken by ``BELIEF`` examples' worth of doubt). Rarity alone finds about half
of the toxic texts, as the words that tell are few among many.

The exact cosine is found with an inverted index of blocks of examples. Rare terms have postings, which are added
up for all examples. Common terms, which most of the work would go into, have a row of weights a block
and the largest weight in it: what the postings give an example, and what the largest weights can add,
bounds its block. Blocks are scored from the highest bounds down, and not at all where the bound does not reach the
k-th cosine found; the nearest are exact. Blocks are made of alike examples, which keeps bounds low, and
texts are scored some hundred at a time.

Neighbours vote with their cosine over their distance. A logistic curve makes the vote a probability at
the share of toxic texts among all labelled rows; it is fitted to the votes that examples get from an
index of the other four fifths, which has not seen their labels.

The examples are a bounded sample (``TOXIC``, ``CLEAN``), chosen by a hash of their ids; the index is
therefore of bounded size, travels with the task, and every whole text is scored in one pass without
a shuffle. Shares of labels are counted over all labelled rows.

A NULL or empty text, or one without known terms, gets the score of no evidence. Equal rows score
alike. Without toxic examples every score is 0. Labels other than 0 and 1 are not learnt from. Of rows
with one labelled id one text is an example, the same at every run. Very long texts are whole, and held by one task.
"""

from __future__ import annotations

import gzip
import io
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forgepulse.llm.support import ROWS_AT_ONCE, row_slices, settle

#: Most examples of each label.
TOXIC, CLEAN = 2048, 4096
#: Letters of a word's beginning as a term beside the word.
BEGINNING = 4
#: Weight of a term as common in toxic as in clean examples, examples' worth of doubt that one is not, and
#: neighbours; chosen by five-fold cross-validation of the learning rows of ``sf0.1``.
UNTELLING, BELIEF, NEIGHBOURS = 1.0, 150, 21
BLOCK = 16
#: Share of the examples from which on a term is common.
COMMON = 0.06
#: Blocks a text that are scored before the bounds are looked at again.
BLOCKS_FIRST = 24

#: Parts of the examples; the votes of each come from an index of the others.
FOLDS = 5
#: Words whose terms a task remembers.
REMEMBERED = 150_000

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Words in lower case."""
    return _WORD.findall((text or "").lower())


def terms_of(
    known: list[str], row: np.ndarray, word: np.ndarray, counts: np.ndarray
) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """From (row, word, count) by row the numbers of all terms, and (row, term, count) by row: the words, and
    the beginnings of longer ones."""
    begun = [w[:BEGINNING] + "-" if len(w) > BEGINNING else None for w in known]
    names = {w: i for i, w in enumerate(known)}
    for beginning in begun:
        if beginning is not None:
            names.setdefault(beginning, len(names))
    begins = np.array([-1 if b is None else names[b] for b in begun], np.int32)
    size, found = max(1, len(names)), [(np.zeros(0, np.int32),) * 3]
    rows = int(row[-1]) + 1 if len(row) else 0
    for low in range(0, rows, ROWS_AT_ONCE):
        part = slice(*np.searchsorted(row, [low, low + ROWS_AT_ONCE]))
        of_word, at = begins[word[part]], row[part].astype(np.int64) * size
        there = of_word >= 0
        cell = np.concatenate([at + word[part], (at + of_word)[there]])
        cell, place = np.unique(cell, return_inverse=True)
        total = np.bincount(place, np.concatenate([counts[part], counts[part][there]]), minlength=len(cell))
        found.append(tuple(a.astype(np.int32) for a in (cell // size, cell % size, total)))
    return names, *map(np.concatenate, zip(*found))


class _Terms(dict):
    """Word -> its terms, in the upper and in the lower half of a number; 0 for none, else one more."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> int:
        begun = self.known.get(word[:BEGINNING] + "-", -1) if len(word) > BEGINNING else -1
        found = (self.known.get(word, -1) + 1 << 32) + begun + 1
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


def _ranges(low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin at ``low``, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)


@dataclass
class Vectors:
    """Sparse vectors of length one, or of length zero: (row, term, weight), by row."""

    rows: int
    row: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, rows: int, row: np.ndarray, term: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> Vectors:
        weight = np.log(counts, dtype=np.float64)
        weight += 1
        weight *= idf[term]
        length = np.sqrt(np.bincount(row, weight * weight, minlength=rows))
        weight /= np.maximum(length, 1e-300)[row]
        # Rounded as the index stores them; sums are in double precision.
        return cls(rows, row, term, weight.astype(np.float32))

    def parts(self, size: int) -> Iterator[Vectors]:
        for low in range(0, self.rows, size):
            high = min(low + size, self.rows)
            part = slice(*np.searchsorted(self.row, [low, high]))
            yield Vectors(high - low, self.row[part] - low, self.term[part], self.weight[part])


@dataclass
class ToxicityIndex:
    """Labelled examples as an inverted index with block maxima of the common terms."""

    terms: dict[str, int]
    idf: np.ndarray
    doc_ids: np.ndarray
    toxic: np.ndarray  # of each lane; lanes behind the last example are empty
    starts: np.ndarray  # of the postings of a rare term, one more at the end
    examples: np.ndarray
    weights: np.ndarray
    common: np.ndarray  # row of a common term, or -1
    block_weights: np.ndarray  # block x row x lane
    block_max: np.ndarray  # row x block
    slope: float = 0.0
    shift: float = 0.0
    of_word: _Terms | None = None

    def vectors(self, texts: list[list[str]]) -> Vectors:
        """Vectors of texts, given by their words, of the terms that some example has."""
        if self.of_word is None:
            self.of_word = _Terms(self.terms)
        sizes = [len(found) for found in texts]
        both = np.fromiter(map(self.of_word.__getitem__, chain.from_iterable(texts)), np.int64, sum(sizes))
        term = np.concatenate([both >> 32, both & 0xFFFFFFFF]) - 1
        row = np.tile(np.repeat(np.arange(len(texts)), sizes), 2)
        size = max(1, len(self.terms))
        cell, total = np.unique((row * size + term)[term >= 0], return_counts=True)
        return Vectors.of(len(texts), cell // size, cell % size, total.astype(np.float64), self.idf)

    def nearest(self, texts: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the highest positive cosines, highest first, and the cosines, (texts x
        neighbours); a cosine of 0 means none."""
        blocks = len(self.block_weights)
        lanes = blocks * BLOCK
        row = self.common[texts.term]
        rare = row < 0
        by_rare = self._by_rare(texts.rows, texts.row[rare], texts.term[rare], texts.weight[rare])
        by_common = np.zeros((texts.rows, self.block_max.shape[0]))
        by_common[texts.row[~rare], row[~rare]] = texts.weight[~rare]
        most_rare = by_rare.reshape(texts.rows, blocks, BLOCK).max(axis=2)
        bound = most_rare + by_common @ self.block_max
        score = np.full((texts.rows, lanes), -np.inf)
        # The best examples of as many blocks as there are neighbours bound the last neighbour from below, by
        # what their postings give alone. A little slack: sums in another order may differ in the last digits.
        least = np.maximum(_at_rank(most_rare, NEIGHBOURS), 0.0)
        open_ = bound > np.maximum(least - 1e-9, 0.0)[:, None]
        first = open_ & (bound >= _at_rank(bound, BLOCKS_FIRST)[:, None])
        self._score(first, by_rare, by_common, score)
        least = np.maximum(_at_rank(score.reshape(texts.rows, blocks, BLOCK).max(axis=2), NEIGHBOURS), least)
        self._score(open_ & ~first & (bound > (least - 1e-9)[:, None]), by_rare, by_common, score)
        return _highest(score, _at_rank(score, NEIGHBOURS))

    def _by_rare(self, rows: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the postings give each (text, lane). Texts are taken together while their postings are few:
        long texts have most terms of the index each."""
        lanes = len(self.block_weights) * BLOCK
        found = np.zeros((rows, lanes))
        sizes = self.starts[term + 1] - self.starts[term]
        ends = np.searchsorted(row, np.arange(rows + 1))
        before = np.append(0, np.cumsum(sizes))[ends]
        low = 0
        while low < rows:
            high = max(low + 1, int(np.searchsorted(before, before[low] + POSTINGS_AT_ONCE, "right")) - 1)
            some = slice(ends[low], ends[high])
            posting = _ranges(self.starts[term[some]], sizes[some])
            cell = np.repeat((row[some] - low).astype(np.int64) * lanes, sizes[some]) + self.examples[posting]
            given = np.repeat(weight[some].astype(np.float64), sizes[some]) * self.weights[posting]
            found[low:high] = np.bincount(cell, given, minlength=(high - low) * lanes).reshape(-1, lanes)
            low = high
        return found

    def _score(self, wanted: np.ndarray, by_rare: np.ndarray, by_common: np.ndarray, score: np.ndarray) -> None:
        """Exact cosines of the wanted (text, block)."""
        for block in np.nonzero(wanted.any(axis=0))[0]:
            texts, lane = np.nonzero(wanted[:, block])[0], slice(block * BLOCK, (block + 1) * BLOCK)
            score[texts, lane] = by_rare[texts, lane] + by_common[texts] @ self.block_weights[block]

    def votes(self, best: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        closeness = cosine / (1.05 - np.minimum(cosine, 1.0))
        # Distant neighbours alone say little: a small share of the vote is for neither.
        return (closeness * self.toxic[best]).sum(axis=1) / (closeness.sum(axis=1) + 0.05)

    def scores(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * votes + self.shift))) if self.slope else np.zeros(len(votes))


def _at_rank(values: np.ndarray, rank: int) -> np.ndarray:
    """The ``rank``-th highest value of each row; minus infinity with fewer columns."""
    if values.shape[1] < rank:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - rank, axis=1)[:, values.shape[1] - rank]


def _highest(score: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the highest positive scores of each row, ties by place."""
    best, value = np.zeros((len(score), NEIGHBOURS), np.int64), np.zeros((len(score), NEIGHBOURS))
    for text in range(len(score)):
        some = np.flatnonzero((score[text] >= least[text]) & (score[text] > 0))
        some = some[np.lexsort((some, -score[text, some]))][:NEIGHBOURS]
        best[text, : len(some)], value[text, : len(some)] = some, score[text, some]
    return best, value


def telling(seen: np.ndarray, toxic: np.ndarray, examples: int, toxic_examples: int) -> np.ndarray:
    """Weights of terms that so many examples, and so many toxic ones, have."""
    clean, clean_examples = seen - toxic, examples - toxic_examples
    share = seen / max(1, examples)
    share = np.where(seen > 0, share, 1.0)
    odds = np.log((toxic + BELIEF * share) / (toxic_examples + BELIEF)) - np.log(
        (clean + BELIEF * share) / (clean_examples + BELIEF)
    )
    # Above none, also for a term of all examples; none for one of no example.
    return np.where(seen > 0, np.log((examples + 2) / (seen + 1)) * (UNTELLING + np.abs(odds)), 0.0)


def build_index(
    examples: list[tuple[int, int, list[str]]], toxic_rows: int, clean_rows: int
) -> ToxicityIndex:
    """Index of (doc_id, toxic, words); the row counts are those of all labelled rows."""
    known = sorted({w for _, _, found in examples for w in found})
    number = {w: i for i, w in enumerate(known)}
    flat = [(n, number[w], c) for n, (_, _, found) in enumerate(examples) for w, c in Counter(found).items()]
    row, word, counts = (np.array(c, np.int64) for c in (zip(*flat) if flat else ((), (), ())))
    ids, toxic = (np.array([e[i] for e in examples], np.int64) for i in (0, 1))
    return index_rows(ids, toxic, *terms_of(known, row, word, counts.astype(np.float64)), toxic_rows, clean_rows)


def index_rows(
    doc_ids: np.ndarray, toxic: np.ndarray, names: dict[str, int], row: np.ndarray,
    term: np.ndarray, counts: np.ndarray, toxic_rows: int, clean_rows: int,
) -> ToxicityIndex:
    """Index of examples by their (row, term, count)."""
    slope = shift = 0.0
    if (toxic == 1).any():
        fold, votes = np.argsort(np.argsort(doc_ids, kind="stable")) % FOLDS, np.zeros(len(doc_ids))
        for number in range(FOLDS):
            asks, there = fold == number, fold[row] != number
            place = (np.cumsum(~asks) - 1).astype(np.int32)
            others = _index(doc_ids[~asks], toxic[~asks], names, place[row[there]], term[there], counts[there])
            own = Vectors.of(
                int(asks.sum()), (np.cumsum(asks) - 1)[row[~there]], term[~there], counts[~there], others.idf
            )
            found = [others.votes(*others.nearest(part)) for part in own.parts(TEXTS_AT_ONCE)]
            votes[asks] = np.concatenate(found) if found else 0.0
            del others, own
        slope, shift = _calibrated(votes, toxic, toxic_rows, clean_rows)
    index = _index(doc_ids, toxic, names, row, term, counts)
    index.slope, index.shift = slope, shift
    return index


def _index(
    doc_ids: np.ndarray, toxic: np.ndarray, names: dict[str, int], row: np.ndarray, term: np.ndarray, counts: np.ndarray
) -> ToxicityIndex:
    count = len(doc_ids)
    seen, in_toxic = (np.bincount(t, minlength=len(names)) for t in (term, term[toxic[row] == 1]))
    idf = telling(seen, in_toxic, count, int((toxic == 1).sum()))
    weights = Vectors.of(count, row, term, counts, idf).weight
    often = np.nonzero(seen > COMMON * count)[0]
    common = np.full(len(names), -1)
    common[often] = np.arange(len(often))
    dense = np.zeros((count, len(often)), np.float32)
    in_row = common[term] >= 0
    dense[row[in_row], common[term[in_row]]] = weights[in_row]

    order = _alike(dense, np.lexsort((doc_ids, toxic)))
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    blocks = max(1, -(-count // BLOCK))
    toxic_at = np.zeros(blocks * BLOCK)
    toxic_at[:count] = toxic[order]
    block_weights = np.zeros((blocks, len(often), BLOCK), np.float32)
    for block in range(blocks):
        some = order[block * BLOCK: (block + 1) * BLOCK]
        block_weights[block, :, : len(some)] = dense[some].T
    del dense

    at, what = place[row[~in_row]].astype(np.int32), term[~in_row]
    by_term = np.lexsort((at, what))
    return ToxicityIndex(
        names, idf, doc_ids[order], toxic_at, np.searchsorted(what[by_term], np.arange(len(names) + 1)),
        at[by_term], weights[~in_row][by_term], common, block_weights,
        np.ascontiguousarray(block_weights.max(axis=2).T).astype(np.float64),
    )


def _alike(dense: np.ndarray, order: np.ndarray) -> np.ndarray:
    """An order in which neighbours have alike rows: cut in halves along the direction in which the rows
    differ most, and each half again, down to blocks. Halves are whole blocks."""
    if not dense.shape[1]:
        return order
    waiting, done = [order], []
    while waiting:
        part = waiting.pop()
        if len(part) <= BLOCK:
            done.append(part)
            continue
        rows = np.empty((len(part), dense.shape[1]))
        for low in range(0, len(part), ROWS_AT_ONCE):
            rows[low: low + ROWS_AT_ONCE] = dense[part[low: low + ROWS_AT_ONCE]]
        rows -= rows.mean(axis=0)
        far = [np.abs(rows[low: low + ROWS_AT_ONCE]).sum(axis=1) for low in range(0, len(part), ROWS_AT_ONCE)]
        direction = rows[np.concatenate(far).argmax()]
        for _ in range(4):
            direction = (rows @ direction) @ rows
            direction /= max(np.sqrt(direction @ direction), 1e-300)
        part = part[np.argsort(rows @ direction, kind="stable")]
        del rows
        half = -(-len(part) // (2 * BLOCK)) * BLOCK
        waiting += [part[half:], part[:half]]
    return np.concatenate(done) if done else order


#: Texts that are compared with the examples at once, and postings that are added up at once where texts are long.
TEXTS_AT_ONCE, POSTINGS_AT_ONCE = 128, 500_000


def _calibrated(
    votes: np.ndarray, labels: np.ndarray, toxic_rows: int, clean_rows: int
) -> tuple[float, float]:
    """Slope and shift of a logistic curve of votes, weighted to the shares of all rows."""
    share = np.where(
        labels == 1, toxic_rows / labels.sum(), clean_rows / max(1.0, (1 - labels).sum())
    )
    x = np.column_stack([votes, np.ones(len(votes))])
    ridge, beta = np.diag([1e-2, 1e-2]) * share.sum() / 1000, np.zeros(2)
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-x @ beta))
        step = np.linalg.solve(
            (x * (share * p * (1 - p))[:, None]).T @ x + ridge,
            x.T @ (share * (labels - p)) - ridge @ beta,
        )
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-6), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> bytes:
    """Index, pickled and packed, from (doc_id, text) and (doc_id, toxic); at most ``toxic`` and ``clean`` examples."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", "toxic"
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.distinct()
    chosen = ids.where("toxic = 1").orderBy(*order).limit(toxic).unionAll(
        ids.where("toxic = 0").orderBy(*order).limit(clean)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            found = [Counter(words(text)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1).cast(pa.int32()),
                pa.array([list(c.items()) for c in found], pa.map_(pa.string(), pa.int64())),
            ], ["doc_id", "toxic", "words"])

    # The chosen ids are at most ``toxic`` + ``clean`` rows; copies of an id become one before they are shuffled.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    )
    counted = settle(texts.select("doc_id", "toxic", "one.text").mapInArrow(
        count, "doc_id long, toxic int, words map<string, long>"
    ), "toxicity-examples")
    rows = (counts.get(1, 0), counts.get(0, 0))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = closed(_fitted(batches, *rows))
        # The process scores texts next; what the examples took is given back before.
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["index"])

    # The examples are few, so one task makes the index of them; the driver only hands it on, packed.
    fitted = settle(counted.coalesce(1).mapInArrow(fit, "index binary"), "toxicity-index")
    return bytes(fitted.first()["index"])


def _fitted(batches: Iterator[pa.RecordBatch], toxic_rows: int, clean_rows: int) -> ToxicityIndex:
    """Index of batches of (doc_id, toxic, words); a batch is numbers before the next one is read."""
    number: dict[str, int] = {}
    ids, toxic, held, word, counts = ([np.zeros(0, kind)] for kind in (np.int64, np.int64, *[np.int32] * 3))
    for batch in batches:
        if not batch.num_rows:
            continue
        found = batch.column(2)
        offsets = found.offsets.to_numpy()
        named = found.keys.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        known = [number.setdefault(w, len(number)) for w in named.dictionary.to_pylist()]
        word.append(np.array(known, np.int32)[named.indices.to_numpy()])
        counts.append(found.items.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy().astype(np.int32))
        held.append(np.diff(offsets))
        ids.append(batch.column(0).to_numpy().astype(np.int64))
        toxic.append(batch.column(1).to_numpy().astype(np.int64))
    ids, toxic, held, word, counts = map(np.concatenate, (ids, toxic, held, word, counts))
    row = np.repeat(np.arange(len(ids), dtype=np.int32), held)
    found = terms_of(list(number), row, word, counts)
    del number, row, word, counts
    return index_rows(ids, toxic, *found, toxic_rows, clean_rows)


def closed(index: ToxicityIndex) -> bytes:
    """Pickled and packed; neither this nor ``opened`` holds the pickle beside the index."""
    packed = io.BytesIO()
    with gzip.GzipFile(fileobj=packed, mode="wb", compresslevel=1, mtime=0) as file:
        pickle.dump(index, file)
    return packed.getvalue()


def opened(index: ToxicityIndex | bytes) -> ToxicityIndex:
    if not isinstance(index, bytes):
        return index
    with gzip.GzipFile(fileobj=io.BytesIO(index)) as file:
        return pickle.load(file)


def score(docs: DataFrame, index: ToxicityIndex | bytes) -> DataFrame:
    """(row, score, evidence): all columns of ``docs``, of which one is text, in ``row``."""
    rows = docs.select(F.struct("*").alias("row"))
    text_at = docs.columns.index("text")
    evidence = "array<struct<doc_id: bigint, toxic: int, cosine: double>>"
    schema = StructType.fromDDL(f"score double, evidence {evidence}")
    schema = StructType([*rows.schema.fields, *schema.fields])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = opened(index)
        for batch in row_slices(batches):
            found = held.vectors([words(text) for text in batch.column(0).field(text_at).to_pylist()])
            best, cosine = (np.concatenate(x) for x in zip(*map(held.nearest, found.parts(TEXTS_AT_ONCE))))
            scores = held.scores(held.votes(best, cosine))
            some = cosine > 0
            reasons = pa.StructArray.from_arrays(
                [held.doc_ids[best[some]], held.toxic[best[some]].astype(np.int32), cosine[some]],
                ["doc_id", "toxic", "cosine"],
            )
            ends = np.append(0, np.cumsum(some.sum(axis=1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.ListArray.from_arrays(ends, reasons)],
                ["row", "score", "evidence"],
            )

    return rows.mapInArrow(rate, schema)


def predicted(score: str | Column = "score") -> Column:
    return F.when(F.col(score) >= 0.5, 1).otherwise(0).cast("int")
