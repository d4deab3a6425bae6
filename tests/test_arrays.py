from __future__ import annotations

import json
import random

import pytest

from forgepulse.sources import arrays
from forgepulse.sources.arrays import ARRAY, OTHER, TORN, ArraySplitter


def split(text: str | bytes, step: int):
    splitter, found = ArraySplitter(), []
    data = text.encode() if isinstance(text, str) else text
    for at in range(0, len(data), step):
        found += splitter.feed(data[at: at + step])
    return splitter.kind or OTHER, [f.decode() for f in found]


TRICKY = [
    1, "a", "", "]", "[", '"', "\\", "\\\"", "\\\\", "a\\", ",", "\n", None, True, [], {}, [[]], {"a": [1, {"b": "]}"}]},
    "é😀", {"\\\"": "\\\\\""}, [",", ["]", "["]], -1.5e-7,
]


@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("indent", [None, 0, 3])
def test_elements_of_any_array_wherever_chunks_end(step, indent):
    for values in (TRICKY, [], [[]], [{}], TRICKY[::-1]):
        text = "\n " + json.dumps(values, indent=indent, ensure_ascii=False) + " \r\n"
        kind, found = split(text, step)
        assert kind == ARRAY and [json.loads(f) for f in found] == values


def test_random_arrays():
    rng = random.Random(1)
    letters = '\\"[]{},: ax\n'

    def value(depth):
        pick = rng.randrange(5 if depth else 3)
        if pick < 2:
            return "".join(rng.choice(letters) for _ in range(rng.randrange(6)))
        if pick == 2:
            return rng.randrange(100)
        if pick == 3:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {str(value(0)): value(depth - 1) for _ in range(rng.randrange(3))}

    for _ in range(300):
        values = [value(3) for _ in range(rng.randrange(6))]
        text = json.dumps(values, indent=rng.choice([None, 1]))
        kind, found = split(text, rng.randrange(1, 20))
        assert kind == ARRAY and [json.loads(f) for f in found] == values


@pytest.mark.parametrize("text, kind", [
    ("", OTHER), (" \n", OTHER), ('{"a": 1}', OTHER), ("[1]\n[2]", OTHER), ("[1] x", OTHER), ("[1,2", TORN), ('["a]', TORN),
    ("[1,]", TORN), ("[,1]", TORN), ("[1,,2]", TORN), ("[1}", TORN), ("[{]}", TORN), ("[", TORN), ("[ ]", ARRAY), ("﻿[1]", ARRAY),
])
def test_what_is_no_array(text, kind):
    for step in (1, 2, 100):
        assert split(text, step)[0] == kind


def test_files_of_many_chunks_and_whole_texts(spark, folder, tmp_path, monkeypatch):
    values = [{"id": n, "text": "é\"]\\" * (n % 50)} for n in range(3000)]
    texts = {"a": json.dumps(values, indent=1), "b": json.dumps(values, indent=1)[:-4], "c": "{}", "d": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    monkeypatch.setattr(arrays, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(arrays, "BATCH_BYTES", 5000)
    monkeypatch.setattr(arrays, "PIECE_BYTES", 10_001)
    files = spark.createDataFrame([(n, str(tmp_path / n)) for n in texts], "file STRING, path STRING")
    rows = arrays.array_elements(files).collect()
    assert {r["file"]: r["kind"] for r in rows if r["kind"]} == {"a": ARRAY, "b": TORN, "c": OTHER, "d": OTHER}
    assert [json.loads(r["value"]) for r in rows if r["file"] == "a" and not r["kind"]] == values
    pieces = arrays.text_pieces(files).orderBy("file", "piece").collect()
    assert {n: "".join(r["value"] for r in pieces if r["file"] == n) for n in texts} == texts
    assert len(pieces) > 10 and max(len(r["value"].encode()) for r in pieces) <= 10_005
