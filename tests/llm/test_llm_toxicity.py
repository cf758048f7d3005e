"""Toxicity: trees, calibration and held-out accuracy."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from greenledger.llm import toxicity as t


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0)).astype(float)
    model = t.boost(x[:1500], y[:1500])
    assert ((model.raw(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_isotonic_rises_and_keeps_the_rates():
    rng = np.random.default_rng(2)
    z = rng.normal(size=3000)
    y = (rng.random(3000) < t.sigmoid(2 * z)).astype(float)
    steps = t.isotonic(z, y)
    assert (np.diff(steps.value) >= 0).all() and steps.value.min() >= 0 and steps.value.max() <= 1
    for low, high in ((-3, -1), (-0.5, 0.5), (1, 3)):
        at = (z > low) & (z < high)
        assert abs(steps(z[at]).mean() - y[at].mean()) < 0.05


def test_features_see_what_they_are_named_for():
    lexicon = t.Lexicon(frozenset({"idiot", "lowei*"}))
    row = dict(zip(t.FEATURES, t.features("YOU are an id1ot, you idiot! loweizzz", lexicon), strict=True))
    assert row["hits"] > 1 and row["disguised"] > 0 and row["you_near"] > 0 and row["exclaim"] > 0
    clean = dict(zip(t.FEATURES, t.features("a calm sentence", lexicon), strict=True))
    assert clean["hits"] == clean["you_near"] == clean["disguised"] == 0
    assert len(t.features("", lexicon)) == len(t.FEATURES)


def test_words_in_any_disguise_are_seen_without_a_plain_one():
    lexicon = t.Lexicon(frozenset({"stupid", "twit"}))
    for text, disguised in (("so 5tupid", 1), ("a 7wit", 1), ("5tupid 7wi7", 2), ("what a st*pid", 0), ("six 6ix", 0)):
        row = dict(zip(t.FEATURES, t.features(text, lexicon), strict=True))
        assert row["hits"] == 0 and row["mixed_words"] > 0, text
        assert round(row["disguised"] * len(t._WORD.findall(text))) == disguised, text
    row = dict(zip(t.FEATURES, t.features("w" * 200_000, lexicon), strict=True))
    assert row["mixed_words"] == 0


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_held_out_accuracy_and_unread_labels(spark, small):
    docs, labels = small("documents").select("doc_id", "text"), small("labels")
    model = t.fit_toxicity(docs, labels)
    rows = t.score_documents(docs, model).join(labels, "doc_id").toPandas()
    out = np.array([zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id])
    assert auc(rows.score[out].to_numpy(), rows.toxic[out].to_numpy()) > 0.9
    assert rows.score.between(0, 1).all()
    flipped = labels.withColumn("toxic", F.when(t.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = t.score_documents(docs, t.fit_toxicity(docs, flipped)).join(labels, "doc_id").toPandas()
    assert rows.sort_values("doc_id").score.tolist() == again.sort_values("doc_id").score.tolist()


def test_held_out_is_the_crc(spark):
    got = spark.range(50).select("id", t.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def test_degenerate_inputs(spark, documents):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    docs = documents([(1, "a"), (2, "b"), (None, "c"), (3, None), (3, None), (4, "")])
    model = t.fit_toxicity(docs, labels)
    got = t.score_documents(docs, model, score_col="score")
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert [r.score for r in got.collect()] == [0.0] * 6
    none = t.fit_toxicity(documents([]), labels.limit(0))
    assert t.score_documents(documents([]), none).collect() == []
