from __future__ import annotations

import numpy as np

from forgepulse.llm import vectors
from tests.llm.cases import components


def brute(rows):
    units = []
    for _, vector, label in rows:
        ok = label is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        units.append(np.array(vector, np.float32).astype(np.float64) if ok else None)
    links = []
    for a in range(len(rows)):
        for b in range(a):
            x, y = units[a], units[b]
            if x is None or y is None or len(x) != len(y) or rows[a][2] != rows[b][2]:
                continue
            if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                links.append((a, b))
    roots, counts, least = components(len(rows), links), [0] * len(rows), {}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    for root, (vec_id, _, _) in zip(roots, rows):
        if vec_id is not None:
            least[root] = min(least.get(root, vec_id), vec_id)
    return [(r[0], n, least.get(root), r[0] is not None and r[0] == least.get(root)) for r, n, root in zip(rows, counts, roots)]


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, 2) for r in rows],
        "vec_id long, embedding array<float>, label int, class int, part int",
    )


def test_clusters_copies_and_odd_vectors_against_brute_force(spark, monkeypatch):
    rng, rows = np.random.default_rng(3), []
    for group in range(60):
        centre = rng.normal(size=20)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), [float(x) for x in centre + rng.normal(size=20) * rng.choice([0.05, 0.2, 0.3])], int(group % 3)))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    rows += [(2000, [0.0] * 20, 1), (2001, None, 1), (2002, [], 1), (2003, [1.0, None] * 10, 1), (2004, [float("nan")] * 20, 1),
             (2005, [float("inf")] + [1.0] * 19, 1), (2006, rows[5][1], None), (2007, rows[5][1][:13], rows[5][2]),
             (None, rows[5][1], rows[5][2]), (None, None, None), (2007, rows[7][1], rows[7][2]), (2008, [-0.0] * 19 + [1.0], 0)]
    want = sorted(map(str, brute(rows)))
    for size, block in ((512, 1024), (16, 64), (16, 2)):  # the last leaves blocks without members
        monkeypatch.setattr(vectors, "LIST_ROWS", size)
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
        for spreads in (vectors.SPREADS, None):
            found = vectors.near_duplicates(frame(spark, rows), spreads=spreads).collect()
            assert sorted(str(tuple(r)) for r in found) == want


def test_nothing_to_compare(spark):
    assert vectors.near_duplicates(frame(spark, [])).count() == 0
    found = vectors.near_duplicates(frame(spark, [(1, None, 1), (1, None, 1)])).collect()
    assert [tuple(r) for r in found] == [(1, 0, 1, True)] * 2


def worst_pairs(rng, count, width):
    """Unit vectors, and one at the threshold for each."""
    first = rng.normal(size=(count, width))
    first /= np.linalg.norm(first, axis=1)[:, None]
    side = rng.normal(size=(count, width))
    side -= (side * first).sum(axis=1)[:, None] * first
    side /= np.linalg.norm(side, axis=1)[:, None]
    return first, 0.93 * first + np.sqrt(1 - 0.93**2) * side


def test_pairs_at_the_threshold_meet_in_a_list_that_one_of_them_visits():
    rng = np.random.default_rng(4)
    first, second = worst_pairs(rng, 20_000, 64)
    for spreads, most_lost in ((vectors.SPREADS, 2e-4), (None, 0)):
        index = vectors.ProductIndex.fit(first[:6000], 120, 0.93, spreads)
        lists = [index.encode(v)[0] for v in (first, second)]
        visits = [index.probes(v, own) for v, own in zip((first, second), lists)]
        met = [b in seen_a or a in seen_b for a, b, seen_a, seen_b in zip(*lists, *visits)]
        apart = lists[0] != lists[1]
        assert apart.mean() > 0.2 and 1 - np.mean(met) <= most_lost
        if spreads is not None:
            assert np.mean([len(v) for v in visits[0]]) < 0.15 * 120


def test_visits_grow_slower_than_the_lists():
    rng = np.random.default_rng(5)
    units = rng.normal(size=(12_000, 64))
    units /= np.linalg.norm(units, axis=1)[:, None]
    visits = []
    for lists in (20, 100):
        index = vectors.ProductIndex.fit(units, lists, 0.93)
        visits.append(np.mean([len(v) for v in index.probes(units, index.encode(units)[0])]))
    assert visits[1] < 2.5 * visits[0]


def test_recall_on_all_given_vectors(spark):
    """Links of the query against all pairs of the table."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]) if r["embedding"] else r["embedding"], r["label"]) for r in table.collect()]
    want = {r[0]: (r[1], r[2]) for r in brute(rows)}
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(table).collect()}
    assert found == want
