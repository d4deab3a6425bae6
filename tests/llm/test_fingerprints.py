from __future__ import annotations

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from forgepulse.llm import fingerprints
from tests.llm.cases import documents, no_documents, odd_documents, odd_rows, prose


def by_id(rows):
    return sorted(rows, key=lambda r: r[0], reverse=True)


def test_edited_texts_fingerprints_and_likeness(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["", None, "é😀x", prose(i, rng.choice([1, 2, 9, 200]))])) for i in rng.sample(range(-500, 500), 90)]
    found = {r["doc_id"]: r for r in fingerprints.compare_with_edits(documents(spark, rows)).collect()}
    order = by_id(rows)
    assert len(found) == len(rows)
    for n, (doc_id, text) in enumerate(order):
        after_id, after = order[(n + 1) % len(order)]
        text, after, row = text or "", after or "", found[doc_id]
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        own, other = int(row["fingerprint"], 16), int(found[after_id]["fingerprint"], 16)
        assert row["near_next"] == 1 - (own ^ other).bit_count() / 128
        assert row["near_edited"] == 1 - (own ^ int(row["edited_fingerprint"], 16)).bit_count() / 128
    marks = {}
    for doc_id, text in rows:
        assert marks.setdefault(text or "", found[doc_id]["fingerprint"]) == found[doc_id]["fingerprint"]


def test_the_plan_runs_no_python(spark):
    docs = documents(spark, [(1, "a b"), (2, "c")])
    plan = fingerprints.with_next(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_votes_are_weighted_by_occurrence(spark):
    texts = spark.createDataFrame([(1, "x y"), (2, "x y x y x y x y x y z"), (3, "q r")], "n long, t string")
    marks = {r["n"]: r["mark"] for r in fingerprints.fingerprints(texts, ["n"], "t").collect()}
    bits = lambda m: (m["high"] & (2**64 - 1)) << 64 | m["low"] & (2**64 - 1)
    assert (bits(marks[1]) ^ bits(marks[2])).bit_count() < (bits(marks[1]) ^ bits(marks[3])).bit_count()


def test_block_tables_find_all_within_the_radius(spark):
    rng, marks = random.Random(5), []
    for _ in range(60):
        base = rng.getrandbits(128)
        for _ in range(4):
            marks.append(base ^ sum({1 << rng.randrange(128) for _ in range(rng.randint(0, 6))}))
    marks = list(set(marks))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [((signed(m >> 64), signed(m & (2**64 - 1))), n % 3 + 1) for n, m in enumerate(marks)]
    frame = spark.createDataFrame(rows, "mark struct<high: bigint, low: bigint>, rows long")
    for radius in (0, 2, 5):
        found = {
            (r["mark"]["high"], r["mark"]["low"]): r["near"]
            for r in fingerprints.near(frame, frame.where(F.col("rows") > 1), radius).collect()
        }
        for n, m in enumerate(marks):
            if n % 3:
                near = sum(k % 3 + 1 for k, o in enumerate(marks) if (m ^ o).bit_count() <= radius)
                assert found[signed(m >> 64), signed(m & (2**64 - 1))] == near


def test_odd_documents(spark):
    found = fingerprints.compare_with_edits(odd_documents(spark, clashing=True)).collect()
    assert sorted(str((r["doc_id"], r["n_chars"])) for r in found) == sorted(
        str((r[0], len(r[1] or ""))) for r in odd_rows()
    )
    assert fingerprints.compare_with_edits(no_documents(spark)).count() == 0
    only = fingerprints.compare_with_edits(documents(spark, [(7, "one two three")])).collect()
    assert [r["near_next"] for r in only] == [1.0]


def test_bits_against_votes_counted_one_by_one(spark):
    """Each pair of neighbouring words votes once for every time it occurs, on all 128 bits."""
    texts = ["", " ", "one", "a b", "a b a b a c", "é 😀 x", prose(3, 300), prose(4, 40) + "\n\n\t" + prose(5, 3), " lead trail "]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, t string")
    found = {r["n"]: r["mark"] for r in fingerprints.fingerprints(frame, ["n"], "t").collect()}
    for n, text in enumerate(texts):
        split = re.split(r"[ \t\n\x0B\f\r]+", text)
        votes, terms = [0] * 128, 0
        for first, second in zip(split, [*split[1:], None]):
            seed = 42
            for word in (first, second):
                if word is not None:
                    seed = xxhash.xxh64_intdigest(word.encode(), seed)
            high, low = seed, xxhash.xxh64_intdigest((1).to_bytes(4, "little"), seed)
            for bit in range(128):
                votes[bit] += (high << 64 | low) >> bit & 1
            terms += 1
        want = sum(1 << bit for bit in range(128) if 2 * votes[bit] > terms)
        assert (found[n]["high"] % 2**64) << 64 | found[n]["low"] % 2**64 == want
