from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (id, text) or (id, text, source), with columns whose
    names clash with those that the operators use inside."""
    clash = ["digest", "norm", "node", "a", "b", "part", "row", "score", "kept", "n", "name", "place", "words", "_salt", "_id", "_text", "_toxicity", "_place", "slot", "tree"]

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.lit(f"clash {c}") for c in clash})
        return df

    return make


@pytest.fixture(scope="session")
def small(spark):
    from greenledger.llm.common import read_table

    return lambda name, sf="/root/testdata/sf0.01": read_table(spark, sf, name)
