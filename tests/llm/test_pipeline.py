from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from forgepulse.llm import queries, toxicity
from forgepulse.llm.tokens import public_tokenizer
from tests.llm.cases import no_documents, odd_documents
from tests.llm.test_models import index_of
from tests.llm.test_simhash_bits import linked, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_have_the_names_and_order_of_the_corpus():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "packing"]


def test_each_stage_works_on_all_that_the_one_before_kept(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(folder(name))
        read = spark.read.parquet(folder(name))
        if name != "packing":
            assert read.schema.names == docs.schema.names
            docs = read
        outputs.append(read.collect())
    start = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    clean, single, private, mixed, packed = outputs

    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    kept = {r["doc_id"] for r in clean}
    assert len([d for d in start if d not in kept and d not in toxic]) <= 0.02 * len(start)

    marks = [slow_fingerprint(r["text"]) for r in clean]
    assert len(single) < len(clean) or not linked(marks, 3)
    left = {r["doc_id"] for r in single}
    assert not linked([slow_fingerprint(r["text"]) for r in single], 3)
    for n, row in enumerate(clean):
        if row["doc_id"] not in left:
            assert any(n in pair for pair in linked(marks, 3))

    assert {r["doc_id"] for r in private} == left
    assert all("@" not in r["text"] or r["text"] != start[r["doc_id"]] for r in private)

    texts = {r["doc_id"]: r["text"] for r in private}
    assert mixed and all(texts[r["doc_id"]] == r["text"] for r in mixed)
    copies: dict = {}
    for row in mixed:
        copies[row["doc_id"]] = copies.get(row["doc_id"], 0) + 1
    assert max(copies.values()) <= 3

    tokenizer, want = Tokenizer.from_file(public_tokenizer()), []
    for row in mixed:
        ids = np.array(tokenizer.encode(row["text"], add_special_tokens=False).ids + [1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at: at + 2048]
            want.append((row["doc_id"], at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    found = [(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packed]
    assert sorted(found) == sorted(want)


def test_run_gives_the_rows_of_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 0 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_odd_rows_and_extra_columns(spark, name, stage):
    docs = odd_documents(spark, clashing=True)
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    rows = out.collect()
    if name in ("toxicity", "pii"):
        assert len(rows) == docs.count()
    assert stage(spark, no_documents(spark), SF).count() == 0


def test_toxic_documents_go_and_clean_ones_stay(spark):
    index = index_of(
        [(i, int(i % 4 == 0), toxicity.words("plain words of a text " + ("vile scum " * 4 if i % 4 == 0 else f"nice{i}")))
         for i in range(200)], 50, 150,
    )
    docs = spark.createDataFrame([(1, "such vile scum " * 5), (2, "plain words only"), (3, None), (4, "")], "doc_id long, text string")
    kept = toxicity.score(docs, index).where(toxicity.predicted() == 0).select("row.doc_id").collect()
    assert {r["doc_id"] for r in kept} == {2, 3, 4}


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
