"""Toxicity: gradient-boosted trees over dense features, calibrated by
isotonic regression.

Training uses a bounded sample of labelled rows (``most_rows``). From it a
lexicon is drawn: words and word beginnings that toxic texts use and others do
not; a row of the sample is measured by a lexicon drawn without its own fold. Each text then becomes a short row of densities - lexicon hits,
second person near hits, capitals, punctuation, obfuscation - on which the trees
are boosted in numpy; sums for rows that the trees have not seen calibrate the
score. The fitted model is a few kB and is broadcast; scoring is one narrow pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import prepare

#: Labelled rows that a model is fitted on at most, chosen by a hash of their id.
MOST_ROWS = 6000

#: Parts of the sample, each measured by lexicons and trees that have not seen it.
FOLDS = 3

#: Terms of the lexicon at most.
MOST_TERMS = 400

#: Second-person words of the languages in the corpus.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous "
                          "votre vos usted ustedes ti tus vosotros".split())

#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

FEATURES = ["log_words", "hits", "hit_density", "hit_kinds", "disguised", "you_density", "you_near", "most_in_50",
            "upper_share", "caps_words", "exclaim", "question", "punctuation", "symbols", "digits", "mixed_words",
            "stretched", "spaced_out"]

_WORD = re.compile(r"\w+")
_MIXED = re.compile(r"(?<!\w)\w*(?:[^\W\d_]\d|\d[^\W\d_]|[^\W\d_][@$!*][^\W\d_])\w*")
_STRETCHED = re.compile(r"(\w)\1{3,}")
_SPACED_OUT = re.compile(r"(?:\b\w[ .\-*_]){4,}")


def stems(word: str) -> list[str]:
    """The word and its beginnings that may be terms, marked by a star."""
    return [word, *(f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k)]


@dataclass
class Lexicon:
    terms: frozenset[str]
    known: dict[str, bool] = field(default_factory=dict)

    def __contains__(self, word: str) -> bool:
        found = self.known.get(word)
        if found is None:
            found = any(s in self.terms for s in stems(word))
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word] = found
        return found


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense row of one whole text, in the order of FEATURES."""
    words = _WORD.findall(text.lower())
    n, size = max(1, len(words)), max(1, len(text))
    toxic = {w for w in set(words) if w in lexicon}
    at = [i for i, w in enumerate(words) if w in toxic] if toxic else []
    mixed = _MIXED.findall(text.lower())
    disguised = sum(any(w in lexicon for w in _WORD.findall(m.translate(DISGUISE))) for m in mixed)
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = sum(any(abs(i - j) <= 5 for j in you) for i in at) if you else 0
    window = max((k - np.searchsorted(at, i - 50, side="right") + 1 for k, i in enumerate(at)), default=0)
    letters = max(1, sum(map(len, words)))
    upper = sum(map(str.isupper, text)) if text != text.lower() else 0
    caps = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if upper > 2 else 0
    count = text.count
    return [math.log1p(len(words)), math.log1p(len(at)), len(at) / n, len(toxic) / n, disguised / n, len(you) / n,
            near / n, float(window), upper / letters, caps / n, count("!") / size, count("?") / size,
            sum(map(count, ".,;:")) / size, sum(map(count, "#*$%&|<>@")) / size, sum(map(count, "0123456789")) / size,
            len(mixed) / n, sum(1 for _ in _STRETCHED.finditer(text)) / n, sum(1 for _ in _SPACED_OUT.finditer(text)) / n]


# --- trees and calibration -------------------------------------------------

@dataclass
class Trees:
    """Boosted trees of a fixed depth as flat arrays: node i has children 2i + 1
    and 2i + 2; a row goes right if its feature is above the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        depth = int(math.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2 ** depth - 1)]
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 3, rate: float = 0.2,
          bins: int = 32, least: float = 1.0, ridge: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss on binned features."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    edges = [np.unique(np.r_[e, 0.0]) for e in edges]  # many densities are mostly 0
    width = max(map(len, edges)) + 1
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    rate_of = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = math.log(rate_of / (1 - rate_of))
    z = np.full(len(y), base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), base)
    offsets = np.arange(x.shape[1]) * width
    for t in range(trees):
        p = sigmoid(z)
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            for at in range(2 ** level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == at)
                if len(rows) > 1:
                    cells = (binned[rows] + offsets).ravel()
                    sums = [np.bincount(cells, np.repeat(v[rows], x.shape[1]), x.shape[1] * width)
                            .reshape(-1, width).cumsum(axis=1) for v in (g, h)]
                    (gl, hl), (ga, ha) = sums, (g[rows].sum(), h[rows].sum())
                    gain = gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge)
                    gain[(hl < least) | (ha - hl < least)] = 0
                    for f, e in enumerate(edges):
                        gain[f, len(e):] = 0
                    f, b = np.unravel_index(np.argmax(gain), gain.shape)
                    if gain[f, b] > 1e-9:
                        model.feature[t, at], model.threshold[t, at] = f, edges[f][b]
            right = x[np.arange(len(y)), model.feature[t][node]] > model.threshold[t][node]
            node = 2 * node + 1 + right
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        model.leaf[t] = -rate * gs / (hs + ridge)
        z += model.leaf[t][leaf]
    return model


@dataclass
class Steps:
    """A rising step function: the value at the last ``at`` that is not above."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, z: np.ndarray) -> np.ndarray:
        return np.interp(z, self.at, self.value)


def isotonic(z: np.ndarray, y: np.ndarray) -> Steps:
    """Pool adjacent violators; each pool stands at the mean of its inputs. Each
    pool's rate is drawn to the middle by half a row of either class."""
    order = np.argsort(z, kind="stable")
    pools: list[list[float]] = []  # sum of y, rows, sum of z
    for zi, yi in zip(z[order], y[order], strict=True):
        pools.append([yi, 1.0, zi])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    value = np.maximum.accumulate([(s + 0.5) / (n + 1) for s, n, _ in pools])
    return Steps(np.array([c / n for _, n, c in pools]), value)


@dataclass
class ToxicityModel:
    terms: frozenset[str]
    trees: Trees | None
    steps: Steps | None

    def scores(self, texts: list[str], lexicon: Lexicon) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(texts))
        x = np.array([features(t, lexicon) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return np.clip(self.steps(self.trees.raw(x)), 0.0, 1.0)


# --- Spark ------------------------------------------------------------------

def held_out(doc_id):
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", most_rows: int = MOST_ROWS) -> ToxicityModel:
    """Fit on at most ``most_rows`` labelled rows that are not held out. Null ids,
    labels and texts are left out of the fit; repeated labels count as their
    largest. Without rows of both classes the model scores every text 0."""
    spark = docs.sparkSession
    prepare(spark)
    known = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sample = (texts.filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")  # most_rows rows of 12 bytes
              .withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")))  # copies share a fold
    lexicons = _lexicons(sample)
    rows = _feature_rows(sample, lexicons)
    y, fold, x = rows[:, 0], rows[:, 1], rows[:, 2:]
    if len({*y}) < 2:
        return ToxicityModel(lexicons[-1], None, None)
    unseen = np.zeros(len(y))  # each row's sum by trees that have not seen its fold
    for k in range(FOLDS):
        unseen[fold == k] = boost(x[fold != k], y[fold != k]).raw(x[fold == k])
    return ToxicityModel(lexicons[-1], boost(x, y), isotonic(unseen, y))


def _lexicons(sample: DataFrame) -> list[frozenset[str]]:
    """For each fold the terms drawn from the others, and last those of all. Each
    task counts its own texts before the shuffle."""

    def run(batches):
        counts: dict[tuple[int, int], Counter] = {}
        for batch in batches:
            for y, fold, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = counts.setdefault((int(y > 0), fold), Counter())
                own.update({s for w in set(_WORD.findall(text.lower())) if len(w) > 2 for s in stems(w)})
                own[""] += 1  # texts
        for (y, fold), own in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([*own], pa.string()), pa.array([2 * fold + y] * len(own), pa.int32()),
                 pa.array([*own.values()], pa.int64())], ["term", "cell", "n"])

    cells = range(2 * FOLDS)
    found = (sample.select("y", "fold", "text").mapInArrow(run, "term string, cell int, n long").groupBy("term")
             .agg(*(F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in cells)))
    good, bad = (sum((F.col(f"c{c}") for c in cells if c % 2 == y), F.lit(0)) for y in (0, 1))
    kept = found.filter((F.col("term") == "") | (bad >= 3) & (bad >= 3 * good))
    rows = kept.orderBy(F.desc(F.col("term") == ""), F.desc(bad), "term").limit(20 * MOST_TERMS).collect()
    if not rows or rows[0].term:
        return [frozenset()] * (FOLDS + 1)
    table = np.array([r[1:] for r in rows], dtype=float).reshape(len(rows), FOLDS, 2)
    out = []
    for left_out in [*range(FOLDS), None]:
        use = [k for k in range(FOLDS) if k != left_out]
        good, bad = table[:, use, 0].sum(axis=1), table[:, use, 1].sum(axis=1)
        fit = (bad >= max(3, bad[0] / 200)) & (bad / max(1, bad[0]) >= 30 * (good + 0.5) / (good[0] + 1))
        fit[0] = False
        best = sorted(np.flatnonzero(fit), key=lambda i: (-bad[i], rows[i].term))[:MOST_TERMS]
        out.append(frozenset(rows[i].term for i in best))
    return out


def _feature_rows(sample: DataFrame, lexicons: list[frozenset[str]]) -> np.ndarray:
    """The features of the bounded sample on the driver, some 150 bytes a row; each
    text is measured by the lexicon that was drawn without its fold."""

    def run(batches):
        own = [Lexicon(terms) for terms in lexicons]
        for batch in batches:
            rows = [features(t, own[k]) for k, t in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))],
                                             ["y", "fold", "x"])

    found = sample.select("y", "fold", "text").mapInArrow(run, "y int, fold int, x array<double>").toArrow()
    rows = [[float(y > 0), float(k), *x] for y, k, x in zip(*(c.to_pylist() for c in found.columns), strict=True)]
    rows.sort()
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES) + 2)


def score_documents(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text",
                    score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; null and empty texts are scored as empty.
    All columns are kept; one with the name of the score is replaced."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)
    rows = docs.drop(score_col) if score_col in docs.columns and score_col != text_col else docs
    at = rows.columns.index(text_col)

    def run(batches):
        lexicon = Lexicon(sent.value.terms)
        for batch in batches:
            scores = sent.value.scores([t or "" for t in batch.column(at).to_pylist()], lexicon)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             [*batch.schema.names, score_col])

    schema = StructType([*rows.schema.fields, StructField(score_col, DoubleType())])
    return rows.mapInArrow(run, schema)
