from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgepulse.llm import negatives

SCHEMA = "vec_id long, label int, vector array<bigint>, block int, query int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def brute(rows, every=5, positives=5, count=3, low=50, high=95):
    able = [(n, *r) for n, r in enumerate(rows) if r[1] is not None and r[2] is not None and None not in r[2]]
    big, out = 2**63, []
    for n, anchor, label, vector in able:
        if anchor is None or anchor % every:
            continue
        others = [
            (-sum(x * y for x, y in zip(v, vector)), big if i is None else i, m, lab)
            for m, i, lab, v in able if m != n and len(v) == len(vector)
        ]
        for score, i, _, _ in sorted(o for o in others if o[3] == label)[:positives]:
            window = sorted(o for o in others if o[3] != label and low * -score <= 100 * -o[0] <= high * -score)[:count]
            out += [(anchor, None if i == big else i, rank + 1, None if o[1] == big else o[1], -score, -o[0]) for rank, o in enumerate(window)]
    return sorted(out, key=str)


def found(spark, rows, every=5, **options):
    mined = negatives.mine(frame(spark, rows), F.col("vec_id") % every == 0, **options)
    return sorted((tuple(r) for r in mined.collect()), key=str)


def clusters(count, width, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width)) * 60
    return [
        (i, int(rng.integers(0, 4)), [int(x) for x in centres[rng.integers(0, 12)] + rng.normal(size=width) * 25])
        for i in range(count)
    ]


@pytest.mark.parametrize("block, leaf, fan", [(8192, 64, 8), (64, 4, 2), (7, 3, 3)])
def test_against_brute_force_over_blocks_of_several_sizes(spark, monkeypatch, block, leaf, fan):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "LEAF_ROWS", leaf)
    monkeypatch.setattr(negatives, "FAN_OUT", fan)
    rows = clusters(500, 9)
    rows += [(600 + i, 1, rows[5][2]) for i in range(40)]  # ties
    want = brute(rows)
    assert len(want) > 500
    assert found(spark, rows) == want
    assert found(spark, rows, every=11, positives=2, negatives=4, low=10, high=120) == brute(rows, 11, 2, 4, 10, 120)


def test_odd_rows(spark):
    same = [3, -4, 5]
    rows = [
        (0, 1, same), (5, 1, same), (10, 1, [0, 0, 0]), (15, None, same), (20, 1, None), (25, 1, [1, None, 2]),
        (30, 2, same), (30, 2, same), (None, 2, [2, -3, 4]), (None, 1, same), (35, 1, []), (36, 2, []), (37, 1, []), (40, 3, [1, 2]),
        (41, 3, [2, 1]), (42, 1, [2, 2]), (45, 1, [-3, 4, -5]), (50, 2, [2, -2, 3]),
    ]
    assert found(spark, rows) == brute(rows)


def test_products_beyond_doubles_are_exact(spark):
    huge = 2**29 + 1
    rows = [(i, i % 2, [huge + i * 3, huge - i, 7 * i]) for i in range(60)]
    assert found(spark, rows, high=101) == brute(rows, high=101)


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, 1, [1, 2]), (1, 2, [1, 2])]) == []  # no positive


def test_search_leaves_out_most_of_a_clustered_block(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(32, 6)) * 1000
    vector = np.round(np.repeat(centres, 64, axis=0) + rng.normal(size=(2048, 6)))
    numbers = np.arange(2048)
    tree = negatives.Tree.pack({
        "number": numbers, "id": numbers, "label": np.zeros(2048, int), "vector": vector,
    })
    anchors = {"number": np.array([-1, -2]), "label": np.zeros(2, int), "vector": vector[[0, 700]]}
    least, most = tree.bounds(anchors["vector"])
    scores = anchors["vector"] @ tree.rows["vector"].T
    for leaf in range(tree.leaves):
        own = scores[:, tree.first[leaf]: tree.after[leaf]]
        assert (least[:, leaf] <= own.min(axis=1)).all() and (own.max(axis=1) <= most[:, leaf]).all()
    found = tree.best(anchors, np.full((2, 1), -np.inf), np.full((2, 1), np.inf), 5, True)
    for at in range(2):
        want = sorted(zip((-scores[at]).tolist(), tree.rows["id"].tolist()))[:5]
        assert list(zip((-found.score[at, 0]).tolist(), found.id[at, 0].tolist())) == want
    assert tree.scored < 2 * 2048 / 4


def test_integers_of_floats(spark):
    rows = spark.createDataFrame(
        [(1, 1, [0.5, -0.001, 1.0]), (2, 1, [float("nan")]), (3, 1, [float("inf")]), (4, 1, None), (5, 1, [None, 1.0])],
        "vec_id long, label int, embedding array<float>",
    )
    got = {r["vec_id"]: r["vector"] for r in negatives.as_integers(rows).collect()}
    assert got == {1: [128, -1, 256], 2: None, 3: None, 4: None, 5: None}
