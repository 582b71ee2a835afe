"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import language_id, line_dedup, packing, simhash_dedup, suffix_dedup
from quillspark.llm.common import drop_settled_since, settle, settled_mark, table


def positional(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """docs under names of our own, whatever its columns are called, and its id's and text's."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain, f"c{docs.columns.index('doc_id')}", f"c{docs.columns.index('text')}"


def restored(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs out of a result over positional(docs), with n_chars brought up to date."""
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    columns = [F.length(at["text"]).cast("long") if c == "n_chars" else F.col(at[c]) for c in docs.columns]
    return out.select(*columns).toDF(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; unlettered texts and texts between two languages go."""
    model = language_id.fit(docs)
    plain, own, text = positional(docs)
    out = language_id.identify(plain, model, own, text).where(~F.col("rejected"))
    return out.select(*plain.columns).toDF(*docs.columns)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of three lines."""
    return restored(line_dedup.dedup_lines(*positional(docs)), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the row of its least id, of several such rows the least row.

    Where no row of a group has an id, the least row of the group stays.
    """
    groups = settle(simhash_dedup.simhash_components(docs))
    least = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    count = settle(least.groupBy("group_id").agg(F.count("*").alias("n"), F.first("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash")))
    plain, own, text = positional(docs)
    key = [F.col(own).eqNullSafe(F.col("doc_id")), F.xxhash64(text) == F.col("text_hash")]
    single = plain.join(count.where("n = 1"), key, "left_semi")
    if count.where("n > 1").isEmpty():  # then documents move once
        return single.toDF(*docs.columns)
    # of several rows with the least id the whole rows are compared
    several = least.join(count.where("n > 1").select("group_id"), "group_id").select("group_id", "doc_id", "text_hash").distinct()
    first = plain.join(several, key).groupBy("group_id").agg(F.min(F.struct(*plain.columns)).alias("row")).select("row.*")
    return single.unionByName(first).toDF(*docs.columns)


def unrepeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes or more that a document with a smaller id holds."""
    plain, own, text = positional(docs)
    out = suffix_dedup.remove_repeats(plain, own, text, carry=[c for c in plain.columns if c != text], as_text=True)
    return restored(out.withColumnRenamed("kept", text), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("simhash_dedup", one_of_each_group),
    ("suffix_dedup", unrepeated_passages),
    ("packing", packed),
]

#: SQL can express neither the compression model nor the tokenizer; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, each written to the shared folder; what a stage was made from is deleted when it is written."""
    docs, mark = table(spark, sf_dir, "documents"), settled_mark()
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
        drop_settled_since(spark, mark, keep=docs)
    return docs
