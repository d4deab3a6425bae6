from __future__ import annotations

import random
import re

from forgepulse.llm import mixing
from tests.llm.cases import documents, no_documents, odd_documents, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by sharing out again and again what is above the limits."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return stopped | share
        stopped |= {s: most * sizes[s] for s in above}


def mixed(docs):
    sized = docs.select("doc_id", "source", "text", mixing.word_count("text").alias("size"))
    return mixing.in_training_order(mixing.mix(sized, "size", "source", mixing.id_key()))


def test_targets_and_shares_of_odd_documents(spark):
    rows = [(*r["row"], r["source_size"], r["target"], r["taken"], r["copies"])
            for r in mixed(odd_documents(spark, clashing=True)).collect()]
    sizes: dict = {}
    for _, text, _, source, _ in odd_rows():
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = water_fill(sizes)
    assert len(rows) == len(odd_rows())
    taken: dict = {}
    for _, source, text, size, source_size, target, words, copies in rows:
        assert size == len(WORD.findall(text or "")) and source_size == sizes[source]
        assert abs(target - want[source]) < 1e-6 and 0 <= words <= 3 * size
        assert words == sum(c["words"] for c in copies) and all(0 <= c["position"] <= 1 for c in copies)
        taken[source] = taken.get(source, 0) + words
    for source, words in taken.items():
        assert abs(words - want[source]) <= 1
    assert mixed(no_documents(spark)).count() == 0


def test_targets_of_random_sources(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 10_000]) for i in range(rng.randint(1, 9))} | {"z": 7}
        frame = spark.createDataFrame([(f"={k}", v) for k, v in sizes.items()], "source_key string, source_size long")
        found = {r["source_key"][1:]: r["target"] for r in mixing.targets(frame).collect()}
        want = water_fill(sizes)
        assert all(abs(found[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = odd_documents(spark)
    columns = ["row.doc_id", "row.size", "target", "taken"]
    once = mixed(docs).select(*columns).collect()
    again = mixed(docs.repartition(5)).select(*columns).collect()
    assert sorted(map(str, once)) == sorted(map(str, again))


def test_positions_follow_the_integral_of_the_weights(spark):
    docs = spark.createDataFrame(
        [(i, prose(i, 50), "a" if i % 2 else "b") for i in range(400)], "doc_id long, text string, source string"
    )
    copies = mixing.copies_in_training_order(
        mixing.mix(docs.withColumn("size", mixing.word_count("text")), "size", "source", mixing.id_key())
    ).select("row.source", "words", "position").collect()
    positions = [c["position"] for c in copies]
    assert positions == sorted(positions)
    # "a" falls from 1.5 to 0.5 times its mean weight: 62.5 % of its words come in the first half.
    first = sum(c["words"] for c in copies if c["source"] == "a" and c["position"] < 0.5)
    assert abs(first / sum(c["words"] for c in copies if c["source"] == "a") - 0.625) < 0.02


def test_copies_of_documents_keep_white_space_and_columns(spark):
    docs = documents(spark, [(i, f"  {prose(i, 30)} \n") for i in range(50)])
    out = mixing.mixed_documents(docs, mixing.id_key())
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = out.collect()
    assert rows and all(r["text"] == texts[r["doc_id"]] for r in rows)


def test_copies_of_documents_are_whole_at_the_limit_of_a_source_too(spark):
    docs = spark.createDataFrame(
        [(i, prose(i, 37), "abc"[i % 3]) for i in range(90)], "doc_id long, text string, source string"
    )
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = mixed(docs).select("row.doc_id", "row.size", "copies").collect()
    assert any(c["words"] < r["size"] for r in rows for c in r["copies"])
    out = mixing.mixed_documents(docs, mixing.id_key()).collect()
    assert len(out) == sum(len(r["copies"]) for r in rows)
    assert all(r["text"] == texts[r["doc_id"]] for r in out)
