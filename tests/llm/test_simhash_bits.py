from __future__ import annotations

import random
import re

import numpy as np
from xxhash import xxh64_intdigest

from forgepulse.llm import simhash_bits
from forgepulse.llm.support import Scratch, remove
from forgepulse.llm.support import components as all_components
from tests.llm.cases import components, documents, no_documents, odd_documents, odd_rows, prose


def slow_fingerprint(text: str | None, size: int = 3) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i: i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_against_the_definition():
    for text in [None, "", " ", "one", "Two WORDS", "É one two three", *[prose(i, 3 + 40 * i) for i in range(12)]]:
        assert simhash_bits.fingerprint(text) & (2**64 - 1) == slow_fingerprint(text)
    long = prose(1, 70_000)
    assert simhash_bits.fingerprint(long) & (2**64 - 1) == slow_fingerprint(long)


def near_marks(seed: int, groups: int) -> np.ndarray:
    rng, marks = random.Random(seed), set()
    for _ in range(groups):
        mark = rng.getrandbits(64)
        marks.add(mark)
        for _ in range(rng.randint(0, 6)):
            other = mark
            for _ in range(rng.randint(0, 5)):
                other ^= 1 << rng.randrange(64)
            marks.add(other)
    marks = list(marks)
    rng.shuffle(marks)
    return np.array(marks, np.uint64)


def linked(marks, radius):
    return [
        (a, b) for a in range(len(marks)) for b in range(a)
        if (int(marks[a]) ^ int(marks[b])).bit_count() <= radius
    ]


def test_bit_planes_connect_what_the_distances_connect():
    marks = near_marks(1, 120)
    for radius in (0, 1, 3, 6):
        links = simhash_bits.spanning_links(marks, np.full(len(marks), len(marks)), radius)
        assert components(len(marks), links) == components(len(marks), linked(marks, radius))


def test_tables_leave_no_pair_out():
    for classes in (10, 10**8, 10**11):
        tables = simhash_bits.band_tables(classes)
        rng = random.Random(classes)
        for _ in range(300):
            difference = sum({1 << rng.randrange(64) for _ in range(3)})
            assert any(difference & mask == 0 for mask in tables)


def test_links_of_many_classes_and_of_split_buckets(spark, monkeypatch):
    marks = near_marks(2, 150)
    frame = spark.createDataFrame([(int(m) - (1 << 64 if int(m) >> 63 else 0),) for m in marks], "mark long")
    want = components(len(marks), linked(marks, 3))
    for rows in (2048, 4):
        monkeypatch.setattr(simhash_bits, "BLOCK_ROWS", rows)
        place = {int(m): i for i, m in enumerate(marks)}
        links = simhash_bits.near_links(frame).collect()
        found = [(place[r["a"] & (2**64 - 1)], place[r["b"] & (2**64 - 1)]) for r in links]
        assert components(len(marks), found) == want


def expected(rows: list[tuple]) -> list[tuple]:
    marks = [slow_fingerprint(r[1]) for r in rows]
    roots = components(len(rows), linked(marks, 3))
    least: dict = {}
    for root, row in zip(roots, rows):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    return [(r[0], f"{m:016x}", least.get(root)) for r, m, root in zip(rows, marks, roots)]


def test_documents_against_brute_force(spark):
    rng = random.Random(9)
    rows = [r[:2] for r in odd_rows()]
    for i in range(300, 380):
        text = prose(i, rng.choice([5, 40, 400]))
        rows.append((i, text))
        if i % 4 == 0:
            rows += [(1000 + i, text), (2000 + i, text + " extra"), (3000 + i, text.upper())]
    found = simhash_bits.near_duplicates(documents(spark, rows)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected(rows)))
    assert simhash_bits.near_duplicates(no_documents(spark)).count() == 0


def test_one_row_of_each_component_stays_with_all_columns(spark):
    docs = odd_documents(spark, clashing=True)
    kept = simhash_bits.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [r[:2] for r in odd_rows()]
    marks = [slow_fingerprint(r[1]) for r in rows]
    groups: dict = {}
    for root, (doc_id, _) in zip(components(len(rows), linked(marks, 3)), rows):
        groups.setdefault(root, []).append(doc_id)
    want = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, want))
    assert simhash_bits.without_near_duplicates(no_documents(spark)).count() == 0


def test_scratch_tables_can_be_dropped(spark):
    scratch = Scratch(spark, "test")
    df, path = scratch.write(spark.range(5).toDF("n"))
    assert df.count() == 5
    remove(path)
    remove(path)


def test_components_by_forests_of_tasks_and_stars(spark):
    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(i, i + 1) for i in range(1000, 1080)] + [(2000, i) for i in range(2001, 2300)] + [(5, 5)]
    frame = spark.createDataFrame(links, "a long, b long")
    roots = dict(enumerate(components(2300, links)))
    want = {n: roots[n] for a, b in links for n in (a, b) if a != b}
    for edges_a_task in (1, 100, 10**6):
        found = {r["node"]: r["component"] for r in all_components(frame.repartition(8), "test", edges_a_task).collect()}
        assert found == want
    assert all_components(frame.limit(0), "test", 1).count() == 0
