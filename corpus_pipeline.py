"""A training corpus from ``documents``: each stage is written and read again by the next one.

toxicity      documents that the nearest labelled examples call toxic go
near_dedup    one document of each group of near duplicates stays
pii           personal data and secrets give way to surrogates
mixing        copies of documents by the target weights of their sources, in training order
packing       token sequences, one row for each piece of a document

Stages take extra columns along, keep NULL and empty texts (which pack to the end id alone) and give an
empty table for an empty table. Stages after the mixing may see a document several times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forgepulse.llm import mixing, packing, simhash_bits, surrogates, toxicity
from forgepulse.llm.support import crc_of_id, settle, table
from forgepulse.llm.tokens import public_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(crc_of_id("doc_id") % 5 != 0)
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.where(toxicity.predicted() == 0).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_bits.without_near_duplicates(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(docs, surrogates.session_key(spark)).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, mixing.id_key())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, public_tokenizer()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models, fingerprints and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
