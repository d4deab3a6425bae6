"""Language of documents by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows, forwards and backwards, and gives every byte
a probability for each language; a document's probabilities are the means over its bytes. It is
trained here in numpy by backpropagation through time, on a bounded sample of labelled rows
(``DOCUMENTS`` a language, ``WINDOWS`` windows of each), and is some kilobytes large, so it travels
with the task and every whole text is read in one pass without a shuffle. Windows of many documents
are read side by side.

A NULL text, or one without a letter, is ``und`` with score 0. Rows without a language are not learnt
from; if no row has one, all are ``und``. Equal texts get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.support import row_slices, settle

UNKNOWN = "und"
HIDDEN = 8
#: Bytes of a window when texts are read, and when the network learns.
READ_BYTES, LEARN_BYTES = 128, 48
#: Labelled rows a language, and windows of each.
DOCUMENTS, WINDOWS = 400, 8
#: Times as many distinct rows of a language as are needed are expected below the bound of their hashes.
SPARE = 4
STEPS, BATCH, RATE = 240, 128, 0.02
#: Windows that are read side by side; their state fits the caches of a core.
LANES = 4096

_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class ByteNetwork:
    """Weights; gates stand in the order reset, update, candidate. Lanes are the last axis."""

    languages: list[str]
    embed: list[np.ndarray]  # by direction: 3 HIDDEN x 256, input weights and bias of each byte
    recur: list[np.ndarray]  # by direction: 3 HIDDEN x HIDDEN
    out: np.ndarray  # languages x 2 HIDDEN
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 1) -> ByteNetwork:
        rng, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        return cls(
            languages, [draw(3 * h, 256) for _ in "fb"], [draw(3 * h, h) for _ in "fb"],
            draw(len(languages), 2 * h), np.zeros(len(languages), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [*self.embed, *self.recur, self.out, self.bias]

    # Learning ------------------------------------------------------------------------------

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all bytes of ``data`` (bytes x lanes) and its gradients, through time."""
        steps, lanes = data.shape
        h, states, kept = HIDDEN, np.zeros((2, steps, HIDDEN, lanes), np.float32), [[], []]
        for d in (0, 1):
            state = np.zeros((h, lanes), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, m = self.embed[d][:, data[t]], self.recur[d] @ state
                gates = _sigmoid(x[: 2 * h] + m[: 2 * h])
                r, z = gates[:h], gates[h:]
                n = np.tanh(x[2 * h:] + r * m[2 * h:])
                kept[d].append((t, state, r, z, n, m[2 * h:]))
                state = n + z * (state - n)
                states[d, t] = state
        both = np.concatenate([states[0], states[1]], axis=1)  # steps x 2 h x lanes
        logits = self.out @ both + self.bias[:, None]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        lane = np.arange(lanes)
        loss = -np.log(p[:, label, lane] + 1e-9).mean()
        p[:, label, lane] -= 1
        p /= steps * lanes
        g_out = np.einsum("tkl,thl->kh", p, both, optimize=True)
        g_both = self.out.T @ p
        g_embed = [np.zeros_like(w) for w in self.embed]
        g_recur = [np.zeros_like(w) for w in self.recur]
        for d in (0, 1):
            back = np.zeros((h, lanes), np.float32)
            for t, before, r, z, n, m in reversed(kept[d]):
                g = back + g_both[t, d * h: (d + 1) * h]
                g_n = g * (1 - z) * (1 - n * n)
                g_z = g * (before - n) * z * (1 - z)
                g_r = g_n * m * r * (1 - r)
                g_x = np.concatenate([g_r, g_z, g_n])
                g_m = np.concatenate([g_r, g_z, g_n * r])
                g_recur[d] += g_m @ before.T
                back = g * z + self.recur[d].T @ g_m
                np.add.at(g_embed[d].T, data[t], g_x.T)
        return float(loss), [*g_embed, *g_recur, g_out, p.sum(axis=(0, 2))]

    def train(self, data: np.ndarray, label: np.ndarray, steps: int = STEPS, seed: int = 2) -> float:
        """Adam over random batches of windows (lanes x bytes), languages in equal parts."""
        rng = np.random.default_rng(seed)
        of = [np.nonzero(label == k)[0] for k in range(len(self.languages))]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights()]
        loss = 0.0
        for step in range(1, steps + 1):
            language = rng.integers(0, len(of), BATCH)
            rows = np.array([of[k][rng.integers(0, len(of[k]))] for k in language])
            loss, slopes = self.gradients(np.ascontiguousarray(data[rows].T), language)
            norm = np.sqrt(sum(float((g * g).sum()) for g in slopes))
            rate = RATE * min(1.0, 3 * (1 - step / (steps + 1))) * min(1.0, 1.0 / max(norm, 1e-9))
            for w, g, (first, second) in zip(self.weights(), slopes, moments):
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        return loss

    # Reading -------------------------------------------------------------------------------

    def label(self, data: np.ndarray) -> np.ndarray:
        """Probabilities of each byte of ``data`` (bytes x lanes): languages x bytes x lanes."""
        steps, lanes = data.shape
        h, logits = HIDDEN, np.empty((len(self.languages), steps, lanes), np.float32)
        for d in (0, 1):
            # A sigmoid is half a tanh plus a half; the halves are put into the weights.
            half = np.repeat(np.float32([0.5, 0.5, 1.0]), h)[:, None]
            scale = np.repeat(np.float32([0.5, 0.5, 0.5]), h)[:, None]
            embed, recur = self.embed[d] * half, self.recur[d] * scale
            out = self.out[:, d * h: (d + 1) * h]
            state = np.zeros((h, lanes), np.float32)
            x, m = np.empty((3 * h, lanes), np.float32), np.empty((3 * h, lanes), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                np.take(embed, data[t], axis=1, out=x, mode="clip")
                np.matmul(recur, state, out=m)
                gates = x[: 2 * h]
                gates += m[: 2 * h]
                np.tanh(gates, out=gates)
                gates += 1
                n = m[2 * h:]
                n *= gates[:h]
                n += x[2 * h:]
                np.tanh(n, out=n)
                state -= n
                state *= gates[h:]
                state *= 0.5
                state += n
                if d == 0:
                    logits[:, t] = out @ state + self.bias[:, None]
                else:
                    logits[:, t] += out @ state
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of whole texts: texts x languages; an empty text has none."""
        sums = np.zeros((len(texts), len(self.languages)))
        lanes_of = [-(-len(t) // READ_BYTES) for t in texts]
        owner = np.repeat(np.arange(len(texts)), lanes_of)
        joined = b"".join([t + bytes(-len(t) % READ_BYTES) for t in texts])
        data = np.frombuffer(joined, np.uint8).reshape(-1, READ_BYTES)
        filled = np.full(len(owner), READ_BYTES)
        for i, end in enumerate(np.cumsum(lanes_of).tolist()):
            if texts[i]:
                filled[end - 1] = len(texts[i]) - READ_BYTES * (lanes_of[i] - 1)
        for first in range(0, len(data), LANES):
            some = slice(first, first + LANES)
            p = self.label(np.ascontiguousarray(data[some].T))
            p *= np.arange(READ_BYTES)[:, None] < filled[some]
            for k, total in enumerate(p.sum(axis=1, dtype=np.float64)):
                sums[:, k] += np.bincount(owner[some], total, minlength=len(texts))
        return sums / np.maximum(1, [len(t) for t in texts])[:, None]


def learn(
    labelled: DataFrame, documents: int = DOCUMENTS, windows: int = WINDOWS, steps: int = STEPS
) -> ByteNetwork:
    """Network from the rows of (doc_id, text, lang) with a language.

    Learns from ``documents`` rows of each language, those of the least hashes of id and text. Equal rows
    count as one, rows that share an id or have none but differ in text as several. Long texts are read
    in ``windows`` pieces here and whole by ``identify``.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("mark")
    )
    marks = settle(known.select("lang", "mark"), "language-marks")
    # Of the distinct rows so many have a mark below the bound that the counting's error does not matter:
    # what meets in a language's task is some times ``documents`` at any size.
    counted = marks.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n"))
    bounds = counted.select("lang", (F.lit(2.0 ** 63 * SPARE * documents) / F.col("n")).alias("bound"))
    low = marks.join(F.broadcast(bounds), "lang").where(
        F.shiftrightunsigned("mark", 1).cast("double") <= F.col("bound")
    )
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("mark", 1), "mark")
    chosen = (
        low.select("lang", "mark").distinct().withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= documents).select("lang", "mark")
    )
    # At most ``documents`` rows a language; rows that are repeated are one.
    texts = known.join(F.broadcast(chosen), ["lang", "mark"]).groupBy("lang", "mark").agg(
        F.min(F.struct("doc_id", "text")).alias("one")
    ).select("one.doc_id", "one.text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows = []
            for doc_id, text, lang in zip(*[c.to_pylist() for c in batch.columns]):
                data, rng = text.encode(), np.random.default_rng(abs(doc_id or 0))
                for start in rng.integers(0, max(1, len(data) - LEARN_BYTES + 1), windows).tolist():
                    rows.append((lang, doc_id, data[start: start + LEARN_BYTES].ljust(LEARN_BYTES)))
            if rows:
                kinds = [pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["lang", "doc_id", "data"]
                )

    found = texts.select("doc_id", "text", "lang").mapInArrow(
        cut, "lang string, doc_id long, data binary"
    ).collect()
    rows = sorted((r["lang"], r["doc_id"] or 0, bytes(r["data"])) for r in found)
    network = ByteNetwork.fresh(sorted({r[0] for r in rows}))
    if rows:
        data = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, LEARN_BYTES)
        label = np.searchsorted(network.languages, [r[0] for r in rows])
        network.train(data, label, steps)
    return network


def identify(docs: DataFrame, network: ByteNetwork) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text of (doc_id, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            texts = batch.column(1).to_pylist()
            written = np.array([bool(t and _LETTER.search(t)) for t in texts], bool)
            written &= len(network.languages) > 0
            data = [t.encode() if w else b"" for t, w in zip(texts, written)]
            languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if written.any():
                pooled = network.documents(data)
                best = pooled.argmax(axis=1)
                scores = np.where(written, pooled.max(axis=1).clip(0, 1), 0.0)
                languages = [network.languages[b] if w else UNKNOWN for b, w in zip(best, written)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores)],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        read, "doc_id long, lang_pred string, score double"
    )

