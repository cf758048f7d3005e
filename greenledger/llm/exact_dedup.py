"""Exact duplicates by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z. Every stage
groups by the digest *and* the full normalised text, so a digest collision can
never merge two texts:

1. locally: equal texts of a map task are combined before the shuffle;
2. salted: (digest, salt) groups meet, so that a group of a third of all rows
   is spread over many tasks;
3. globally: the few salt winners of each text meet and one row stays.

Members find their group by its digest alone; the texts of a collided digest,
found exactly in stage 3, are joined by digest and text instead.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, attach, salt, staged


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def duplicate_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: (digest, text, keep_id, group_size, collided),
    where text is null unless another text has the same digest."""
    rows = _rows(docs, id_col, text_col, digest, salts)
    salted = rows.groupBy("digest", "_salt", "norm").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    merged = (salted.repartition("digest").groupBy("digest", "norm")
              .agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size")))
    collided = F.count(F.lit(1)).over(Window.partitionBy("digest")) > 1
    return (merged.withColumn("collided", collided)
            .select("digest", F.when(F.col("collided"), F.col("norm")).alias("norm"),
                    "keep_id", "group_size", "collided"))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row;
    the largest id of equal texts stays.

    A null text counts as empty. Repeated rows with one id are rows of their own:
    they count in group_size, and all rows with the id that stays are kept. Null
    ids lose to any other; in a group of null ids only, all are kept with a null
    keep_id. Other columns are ignored; an empty table gives an empty result."""
    rows = _rows(docs, id_col, text_col, digest, salts)
    members = staged(rows.drop("norm", "_salt"), "digests")  # read twice below; texts are hashed once for it
    groups = staged(duplicate_groups(docs, id_col=id_col, text_col=text_col, digest=digest, salts=salts),
                    "exact-groups")
    plain = groups.filter(~F.col("collided")).drop("norm", "collided")
    out = attach(members, plain, ["digest"], "doc_id", salts=salts)
    if not groups.filter("collided").isEmpty():
        clash = groups.filter("collided").drop("collided")
        texts = rows.drop("_salt").join(clash.select("digest").distinct(), "digest", "left_semi")
        out = out.unionByName(attach(texts, clash, ["digest", "norm"], "doc_id", salts=salts).drop("norm"))
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _rows(docs, id_col, text_col, digest, salts):
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), normalised(docs[text_col]).alias("norm"))
    return rows.select("doc_id", "norm", digest(F.col("norm")).alias("digest"),
                       sha256(F.col("norm")).alias("text_sha256"), salt(F.col("doc_id"), salts).alias("_salt"))
