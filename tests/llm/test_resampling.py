from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from forgepulse.llm import resampling
from tests.llm.cases import CLASHING, documents, no_documents, odd_documents, odd_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, order):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, order=1, buckets=resampling.BUCKETS, least=resampling.LEAST_WORDS, percent=resampling.PERCENT):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    own = Counter(bucket(f) for _, t in rows for f in features(t, order)[1])
    wanted = Counter(bucket(f) for t in target for f in features(t, order)[1])
    s, t = sum(own.values()), sum(wanted.values())
    out = []
    for doc_id, text in rows:
        words, found = features(text, order)
        gains = [
            math.floor(1000 * math.log((wanted[bucket(f)] + 1.0) * (s + buckets) / ((own[bucket(f)] + 1.0) * (t + buckets))))
            for f in found
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words)])
    able = sorted((o for o in out if o[5] >= least), key=lambda o: (-o[3], math.inf if o[0] is None else o[0]))
    for place, o in enumerate(able[: percent * len(able) // 100]):
        o[4] = place + 1
    return sorted((tuple(o[:5]) for o in out), key=str)


def found(docs, target, **options):
    return sorted((tuple(r) for r in resampling.resample(docs, target, **options).collect()), key=str)


def texts(spark, rows):
    return spark.createDataFrame([(t,) for t in rows], "text string")


def test_all_columns_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randrange(0, 90)) + " Ümläut" * (i % 3) + " A-B c9" * (i % 5)) for i in range(400)]
    target = [prose(1000 + i, 40) for i in range(10)]
    assert found(documents(spark, rows), texts(spark, target)) == brute(rows, target)
    assert found(documents(spark, rows), texts(spark, target), order=3, buckets=97, percent=50) == brute(
        rows, target, order=3, buckets=97, percent=50
    )


def test_odd_documents(spark):
    rows, target = [(r[0], r[1]) for r in odd_rows()], ["river Stone", None, ""]
    want = brute(rows, target, least=1, percent=100)
    for clashing in (False, True):
        docs = odd_documents(spark, clashing)
        assert set(CLASHING) <= set(docs.columns) or not clashing
        got = found(docs, texts(spark, target), least_words=1, percent=100)
        # Rows with one id and one score may take each other's rank.
        assert [r[:4] for r in got] == [r[:4] for r in want]
        assert sorted(r[4] or 0 for r in got) == sorted(r[4] or 0 for r in want)
        assert {r[4]: r[0] for r in got if r[4]} == {r[4]: r[0] for r in want if r[4]}


def test_no_documents_and_no_target(spark):
    assert found(no_documents(spark), texts(spark, ["a"])) == []
    rows = [(1, "a b c " * 20), (2, None)]
    assert found(documents(spark, rows), texts(spark, []), percent=100) == brute(rows, [], percent=100)


def test_vectorised_hash_is_that_of_the_library():
    rng = np.random.default_rng(1)
    for length in [*range(1, 40), 64, 100]:
        rows = np.zeros((20, -(-length // 8) * 8), np.uint8)
        rows[:, :length] = rng.integers(0, 256, (20, length))
        want = [xxhash.xxh64_intdigest(r[:length].tobytes()) for r in rows]
        assert resampling.xxh64(rows.view("<u8"), length).tolist() == want


def test_bytes_decide_where_hashes_clash():
    """All strings get one hash: each distinct one still has its own slot, found by verified bytes."""
    values = np.random.default_rng(2).integers(0, 40, 500).astype("<u8")[:, None]
    slot, owner = resampling.interned(values, np.full(500, 7, np.uint64))
    assert (values[owner[slot]] == values).all()
    assert len(set(slot.tolist())) == len(set(values[:, 0].tolist())) == (owner >= 0).sum()


def test_words_end_with_their_text_and_tables_may_be_small(monkeypatch):
    column = pa.array([b"ab", b"", b"cd ef", b"9", b"--", "é".encode()], pa.binary())
    grams = resampling.grams_of(column, 2)
    found = [bytes(grams.data[s: s + n]).decode() for s, n in zip(grams.start, grams.length)]
    assert found == ["ab", "cd", "ef", "9", "é", "cd ef"]
    assert grams.text.tolist() == [0, 2, 2, 3, 5, 2] and grams.words.tolist() == [1, 0, 2, 1, 0, 1]
    assert resampling.grams_of(column[2:4], 1).text.tolist() == [0, 0, 1]
    monkeypatch.setattr(resampling, "TABLE_BYTES", 8)
    tables = list(resampling._tables(grams, 10))
    assert sorted(int(i) for some, *_ in tables for i in some) == list(range(6))


def test_draw_follows_the_target(spark):
    """Documents in the words of the target are drawn far more often."""
    rows = [(i, " ".join(["apple pear plum", "iron zinc lead"][i % 2].split() * 10)) for i in range(300)]
    drawn = resampling.resample(documents(spark, rows), texts(spark, ["apple pear plum " * 50])).where("rank is not null")
    ids = [r["doc_id"] for r in drawn.collect()]
    assert len(ids) == 30 and sum(i % 2 == 0 for i in ids) >= 25
    assert drawn.agg(F.max("rank")).first()[0] == 30
