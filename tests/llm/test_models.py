"""Toxicity and language: exact search, gradients, odd rows and held-out accuracy."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forgepulse.llm import language, queries, toxicity
from tests.llm.cases import documents, no_documents, odd_documents, odd_rows, prose

SF = "/root/testdata/sf0.01"


def index_of(rows, toxic_rows, clean_rows):
    """Index of (doc_id, toxic, words)."""
    return toxicity.build_index(rows, toxic_rows, clean_rows)


def examples(count: int):
    rng, out = random.Random(1), []
    for i in range(count):
        toxic = int(i % 4 == 0)
        words = [f"w{rng.randint(0, 60):02d}x" for _ in range(40)] + ["scumbag"] * (3 * toxic)
        out.append((i, toxic, toxicity.words(" ".join(words).replace("0", "o").replace("1", "l").replace("2", "z"))))
    return out


def dense_rows(index, vectors):
    out = np.zeros((vectors.rows, len(index.terms)))
    out[vectors.row, vectors.term] = vectors.weight
    return out


@pytest.mark.parametrize("common", [0.0, 0.08, 2.0])
def test_the_index_finds_the_nearest_exactly(monkeypatch, common):
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "BLOCKS_FIRST", 3)
    rows = examples(403)
    index = index_of(rows, 100, 303)
    counts_of = {i: counts for i, _, counts in rows}
    held = dense_rows(index, index.vectors([counts_of[d] for d in index.doc_ids.tolist()]))
    texts = index.vectors([c for _, _, c in examples(600)[403:]] + [[], ["unknown"] * 3])
    best, found = index.nearest(texts)
    for text, cosine in enumerate(dense_rows(index, texts) @ held.T):
        want = np.sort(cosine[cosine > 1e-12])[::-1][: toxicity.NEIGHBOURS]
        some = found[text] > 0
        assert np.allclose(found[text, some], want) and np.allclose(cosine[best[text, some]], want)


def test_blocks_that_cannot_reach_the_nearest_are_not_scored(monkeypatch):
    index = index_of(examples(1600), 400, 1200)
    scored = []
    own = toxicity.ToxicityIndex._score
    monkeypatch.setattr(
        toxicity.ToxicityIndex, "_score", lambda self, wanted, *rest: scored.append(wanted.sum()) or own(self, wanted, *rest)
    )
    index.nearest(index.vectors([counts for _, _, counts in examples(40)]))
    assert 0 < sum(scored) < 40 * len(index.block_weights)


def test_blocks_are_made_of_alike_examples():
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 8, 400)
    dense = np.eye(8)[kinds] + rng.random((400, 8)) * 0.01
    order = toxicity._alike(dense, np.arange(400))
    assert sorted(order) == list(range(400))
    assert sum(len(set(kinds[order[i: i + 16]])) for i in range(0, 400, 16)) <= 25 + 14


def test_long_texts_are_compared_in_little_memory():
    rng, names = random.Random(2), ["".join(chr(97 + (i // 26**p) % 26) for p in range(4)) for i in range(4000)]
    index = index_of([(i, int(i % 4 == 0), rng.sample(names, 150)) for i in range(800)], 200, 600)
    texts = index.vectors([rng.sample(names, 3800) for _ in range(60)])
    tracemalloc.start()
    best, cosine = index.nearest(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Some 110,000 postings a text; 197 MB where they are added up all at once.
    assert peak < 60e6
    alone = [index.nearest(part) for part in texts.parts(1)]
    assert np.allclose(cosine, np.concatenate([c for _, c in alone])) and (best == np.concatenate([b for b, _ in alone])).all()


def test_an_index_is_made_in_little_memory():
    rng = random.Random(3)
    names = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(30_000)]
    rows = [(i, int(i % 4 == 0), rng.sample(names, 300)) for i in range(1500)]
    batches = [pa.RecordBatch.from_arrays([
        pa.array([i for i, _, _ in part], pa.int64()), pa.array([t for _, t, _ in part], pa.int32()),
        pa.array([[(w, 1) for w in found] for _, _, found in part], pa.map_(pa.string(), pa.int64())),
    ], ["doc_id", "toxic", "words"]) for part in (rows[:700], [], rows[700:])]
    tracemalloc.start()
    index = toxicity._fitted(iter([*batches, batches[0].slice(0, 0)]), 400, 1100)
    peak = tracemalloc.get_traced_memory()[1]
    packed = toxicity.closed(index)
    tracemalloc.stop()
    terms = len(index.examples) + (index.block_weights > 0).sum()
    assert peak < 90 * terms  # 130 bytes a term of an example before
    same, again = index_of(rows, 400, 1100), toxicity.opened(packed)
    texts = [found for _, _, found in rows[:40]]
    want = same.nearest(same.vectors(texts))
    for one in (index, again):
        best, cosine = one.nearest(one.vectors(texts))
        assert np.allclose(cosine, want[1]) and (one.slope, one.shift) == pytest.approx((same.slope, same.shift))
        assert (one.doc_ids[best[:, 0]] == same.doc_ids[want[0][:, 0]]).all()


def test_terms_are_whole_words_and_beginnings():
    assert toxicity.words("Idiots idiot, ab_cd 7x Ünder") == ["idiots", "idiot", "ab", "cd", "x", "ünder"]
    assert toxicity.words(None) == toxicity.words("12 _ !") == []
    names, row, term, count = toxicity.terms_of(["idiots", "idiot", "ab"], np.array([0, 0, 0, 1]), np.array([0, 1, 2, 1]), np.array([1.0, 2, 1, 5]))
    by_name = {(r, n): c for r, t, c in zip(row, term, count) for n, i in names.items() if i == t}
    assert by_name == {(0, "idiots"): 1, (0, "idiot"): 2, (0, "ab"): 1, (0, "idio-"): 3, (1, "idiot"): 5, (1, "idio-"): 5}
    index = index_of([(0, 1, ["idiots", "idiot", "idiot", "ab"]), (1, 0, ["idiot"] * 5)], 1, 1)
    own = index.vectors([["idiot", "idiots", "ab", "idiot", "idiom"]])
    assert sorted(own.term.tolist()) == sorted(index.terms[t] for t in ("idiots", "idiot", "ab", "idio-"))


def test_rare_and_common_terms_are_evidence_too():
    rng = random.Random(4)
    rows = [(i, int(i % 4 == 0), toxicity.words(" ".join(f"w{chr(97 + rng.randint(0, 25))}" for _ in range(30))))
            for i in range(400)]
    # Terms that one example has, or every clean one.
    rows.append((1000, 1, toxicity.words("zqxj zqxk zqxw zqxv")))
    rows = [(i, t, c if t else [*c, "ever"]) for i, t, c in rows]
    rows.append((1001, 0, ["ever", "ever"]))
    index = index_of(rows, 101, 301)
    assert {"zqxj", "ever"} <= index.terms.keys() and (index.idf > 0).all()
    for doc_id in (1000, 1001):
        counts = next(c for i, _, c in rows if i == doc_id)
        best, cosine = index.nearest(index.vectors([counts]))
        assert index.doc_ids[best[0, 0]] == doc_id and abs(cosine[0, 0] - 1) < 1e-6


def test_a_copy_of_a_toxic_example_of_rare_words_has_it_as_evidence(spark):
    # Words that a single example of 400 has.
    own = {i: " ".join(f"{a}{b}{'bcdfghjklm'[i // 4 % 10]}{'aeiouyrstw'[i // 40]}" for a in "xqz" for b in "aeiou")
           for i in range(0, 400, 4)}
    docs = documents(spark, [(i, own.get(i) or prose(i, 40)) for i in range(400)] + [(900, own[8])])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    index = toxicity.learn(docs, labels)
    found = toxicity.score(docs.where("doc_id = 900"), index).first()
    assert found["evidence"][0]["doc_id"] == 8 and abs(found["evidence"][0]["cosine"] - 1) < 1e-6


def test_repeated_ids_are_one_example(spark):
    docs = documents(spark, [(7, prose(i % 3, 30)) for i in range(3000)] + [(i, prose(i, 30)) for i in range(100, 140)])
    labels = spark.createDataFrame([(7, 1)] * 3000 + [(i, i % 2) for i in range(100, 140)], "doc_id long, toxic int")
    index = toxicity.opened(toxicity.learn(docs, labels))
    assert len(index.doc_ids) == 41 and (index.doc_ids == 7).sum() == 1


def test_toxicity_of_odd_documents(spark):
    index = index_of(examples(400), 100, 300)
    docs = odd_documents(spark, clashing=True)
    scored = toxicity.score(docs, index)
    assert scored.select("row.*").columns == docs.columns
    rows = scored.select("row.doc_id", "row.text", "score", "evidence").collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    none = index.scores(index.votes(*index.nearest(index.vectors([[]]))))[0]
    assert all(r["score"] == none and r["evidence"] == [] for r in rows if not (r["text"] or "").strip())
    assert toxicity.score(no_documents(spark), index).count() == 0


def test_learning_without_toxic_rows_or_any(spark):
    docs = documents(spark, [(i, prose(i, 30)) for i in range(20)] + [(None, "x")])
    labels = spark.createDataFrame([(i, 0) for i in range(10)] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        rows = toxicity.score(docs, toxicity.learn(docs, known)).collect()
        assert len(rows) == 21 and all(r["score"] == 0 for r in rows)


def test_held_out_toxicity(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    right = Counter(labels[r["doc_id"]] == r["predicted"] for r in held)
    assert right[True] / len(held) > 0.93
    assert sum(r["predicted"] for r in held if not labels[r["doc_id"]]) <= 0.02 * len(held)


# Language ------------------------------------------------------------------------------------


def test_gradients_through_time_against_differences():
    rng = np.random.default_rng(3)
    network = language.ByteNetwork.fresh(["a", "b", "c"])
    network.embed = [w.astype(float) for w in network.embed]
    network.recur = [w.astype(float) for w in network.recur]
    network.out, network.bias = network.out.astype(float), network.bias.astype(float)
    data, label = rng.integers(97, 110, (9, 6)), np.array([0, 1, 2, 0, 1, 2])
    _, slopes = network.gradients(data, label)
    for weight, slope in zip(network.weights(), slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        losses, middle = [], weight[at]
        for step in (1e-3, -1e-3):
            weight[at] = middle + step
            losses.append(network.gradients(data, label)[0])
        weight[at] = middle
        assert abs((losses[0] - losses[1]) / 2e-3 - slope[at]) < 1e-3 * max(1, abs(slope[at]))


def test_whole_texts_are_pooled_over_all_their_bytes():
    network = language.ByteNetwork.fresh(["a", "b"])
    texts = [b"", b"x", b"ab" * 64, prose(1, 2000).encode()]
    pooled = network.documents(texts)
    for text, found in zip(texts, pooled):
        total = np.zeros(2)
        for start in range(0, len(text), language.READ_BYTES):
            window = text[start: start + language.READ_BYTES].ljust(language.READ_BYTES, b"\0")
            data = np.frombuffer(window, np.uint8).reshape(-1, 1)
            total += network.label(data)[:, : len(text) - start, 0].sum(axis=1)
        assert np.allclose(found, total / max(1, len(text)), atol=1e-4)


def plain_probabilities(network, text):
    """Of each byte, by the gates as written down for such a network, a byte at a time."""
    h, sigmoid = language.HIDDEN, lambda x: 1 / (1 + np.exp(-x))
    states = np.zeros((2, len(text), h))
    for way, places in ((0, range(len(text))), (1, reversed(range(len(text))))):
        state = np.zeros(h)
        for t in places:
            given, held = network.embed[way][:, text[t]].astype(float), network.recur[way].astype(float) @ state
            reset, update = sigmoid(given[:h] + held[:h]), sigmoid(given[h: 2 * h] + held[h: 2 * h])
            candidate = np.tanh(given[2 * h:] + reset * held[2 * h:])
            state = (1 - update) * candidate + update * state
            states[way, t] = state
    values = np.exp(np.hstack([states[0], states[1]]) @ network.out.T.astype(float) + network.bias)
    return values / values.sum(axis=1, keepdims=True)


def test_the_network_against_a_plain_forward_pass():
    rng = np.random.default_rng(6)
    network = language.ByteNetwork.fresh(["a", "b", "c"], seed=7)
    network.bias = rng.normal(size=3).astype(np.float32)
    data = rng.integers(0, 256, (language.READ_BYTES, 5)).astype(np.uint8)
    found = network.label(data)
    for lane in range(5):
        assert np.allclose(found[:, :, lane].T, plain_probabilities(network, data[:, lane]), atol=1e-4)


def test_repeated_and_missing_ids_are_learnt_from_within_the_bound(spark, monkeypatch):
    """A row that is repeated counts once; one id with many texts, or none, stays within the bound."""
    kept = []
    monkeypatch.setattr(language.ByteNetwork, "train", lambda self, data, label, steps: kept.append((data, label)))
    rows = [(7, "the same text again", "en")] * 3000 + [(8, prose(i, 20), "de") for i in range(300)]
    rows += [(None, prose(i, 20), "fr") for i in range(500, 800)] + [(9, prose(900, 20), "fr")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.learn(docs, documents=40, windows=2)
    data, label = kept[0]
    assert [int((label == k).sum()) for k in range(3)] == [80, 2, 80]  # de, en, fr
    language.learn(docs.repartition(5), documents=40, windows=2)
    assert (kept[1][0] == data).all() and (kept[1][1] == label).all()


def test_language_of_odd_documents(spark):
    docs = odd_documents(spark, clashing=True)
    network = language.learn(docs, steps=5)
    rows = language.identify(docs, network).collect()
    texts = {str(r[0]): r[1] for r in odd_rows() if r[0] is not None}
    assert len(rows) == len(odd_rows())
    for row in rows:
        text = texts.get(str(row["doc_id"]))
        if row["doc_id"] is not None:
            unknown = not any(c.isalpha() for c in text or "")
            assert (row["lang_pred"] == "und") == unknown and 0 <= row["score"] <= 1
            assert row["score"] == 0 if unknown else row["lang_pred"] in network.languages
    assert language.identify(no_documents(spark), network).count() == 0
    blank = language.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify(docs, blank).collect()} == {"und"}


def test_held_out_language(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op3_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
