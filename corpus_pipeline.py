"""A training corpus from raw documents, stage by stage.

Each stage works on all rows that the one before kept, written as Parquet in
between: toxic documents go, exact copies go, of near copies one stays, the rest
is put into the order of a mix of its sources, and is encoded. The result has each
document's place in the mix, so that its order outlasts the stages' files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm import bpe_codec, exact_dedup, minhash_dedup, mixing, queries, toxicity
from greenledger.llm.common import attach, prepare, read_table, staged, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. The model is fitted on
    labelled rows of the whole table; null and empty texts are scored as empty."""
    model = toxicity.fit_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    score = unused(docs, "toxicity")
    scored = toxicity.score_documents(docs, model, score_col=score)
    return scored.filter(F.col(score) < queries.TOXIC_FROM).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each exact text. Of rows that share the id that stays, one
    stays; of texts that only rows with a null id have, one row stays."""
    prepare(spark)
    return _only(docs, exact_dedup.exact_dedup(docs).select("doc_id", "kept", "text_sha256"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near copies (five
    words, similarity 0.8); documents without words all stay."""
    found = minhash_dedup.near_dedup(docs).select("doc_id", "kept")
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: files and rows follow one another by
    place, so that readers in file order see the sources at their target weights."""
    return mixing.in_order(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' number and digests of each document, and its slot and place in the
    mix. Rows that share an id, or have none, stand at the first place of these."""
    keys = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_null")]
    first = mixing.mix_sources(docs).groupBy(*keys).agg(F.min("slot").alias("slot"), F.min("place").alias("place"))
    tokens = staged(bpe_codec.token_digests(docs, queries.VOCABULARY), "tokens")  # read twice below
    return attach(tokens.select("*", *keys), first, ["_id", "_null"], "ids_sha256").select(*tokens.columns, "slot", "place")


def _only(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are kept, once each."""
    keys = [unused(docs, "digest"), unused(docs, "id")]

    def keyed(rows: DataFrame, text: Column) -> DataFrame:
        return rows.select("*", text.alias(keys[0]), F.coalesce("doc_id", F.lit(-(1 << 63))).alias(keys[1]))

    kept = keyed(found.filter("kept").select("doc_id", "text_sha256"), F.col("text_sha256")).select(*keys).distinct()
    rows = keyed(docs, exact_dedup.sha256(exact_dedup.normalised(F.col("text"))))
    return rows.join(kept, keys).dropDuplicates(keys).select(docs.columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mix", mix),
    ("encode", encode),
]

ORACLE_SQL = None  # a fitted model and token ids are beyond SQL; the tests hold it against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
