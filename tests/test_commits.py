from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from forgepulse.sources.commits import commit, create_new, read_commits


@pytest.mark.parametrize("hadoop", [False, True])
def test_a_file_is_created_once_and_whole(spark, folder, hadoop):
    path = folder("log") + "/1.json"
    assert create_new(spark, path, "a", hadoop)
    assert not create_new(spark, path, "b", hadoop)
    assert Path(path).read_text() == "a"
    assert [p.name for p in Path(folder("log")).iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_of_many_writers_each_number_has_one(spark, folder):
    def write(writer: int) -> list[int]:
        return [n for n in range(1, 21) if commit(spark, "file:" + folder("log"), n, [{"writer": writer}])]

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(write, range(8)))
    assert sorted(n for numbers in got for n in numbers) == list(range(1, 21))
    rows = read_commits(spark, folder("log"), "writer INT").collect()
    assert {r["number"]: r["writer"] for r in rows} == {n: w for w, numbers in enumerate(got) for n in numbers}


def test_an_empty_log(spark, folder):
    assert read_commits(spark, folder("log"), "a INT").count() == 0
    assert commit(spark, folder("log"), 1, [{"a": 1}, {"a": None}])
    assert sorted((r["number"], r["a"]) for r in read_commits(spark, folder("log"), "a INT").where("a > 0").collect()) == [(1, 1)]
