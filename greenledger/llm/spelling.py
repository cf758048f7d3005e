"""Spelling variants by pivotal grams.

Two words one edit apart share one of any two disjoint bigrams of either word
untouched: an edit harms one of them at most. All bigrams are ordered from rare to
common; a word's prefix is its three rarest bigrams and all occurrences of these.
Of each pair, the word whose prefix ends earlier in that order finds the other: two
disjoint bigrams of its prefix, its pivots, chosen to be rarest together by dynamic
programming, are looked up in the prefixes of all words. Position limits are
strict: around an untouched bigram the single edit lies wholly before or wholly
behind it, so one side, up to the bigram, is the same in both words, and their
lengths differ by one at most. The other side is cut into a few parts: the edit lies in
one of them, and the others are the same too. All this is part of the key; what is
found is verified by edit distance.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, attach, prepare, staged

#: Letters of a word: 26 and 64 after lower-casing, so 8,100 bigrams at most.
LETTERS = r"[A-Za-zÀ-ÿ]+"

#: Code points of a word and occurrences at least, and how many times as frequent a form is.
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10

#: Every so many occurrences, by a checksum of document and run, lose a letter.
DAMAGE = 31

#: The edits a pair may differ by, the letters of a gram, and the parts of a side.
EDITS, GRAM, PARTS = 1, 2, 3


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters of whole texts, A-Z lower-cased, counted over all
    documents. With ``damage``, a run loses a letter where that number divides the
    crc32 of ``<doc_id>:<run>``. Null texts have no words; a null id is written as
    nothing before the colon."""
    runs = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("doc"),
                       F.explode(F.regexp_extract_all(docs[text_col].cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length).select(
        "doc", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("word"))
    if damage:
        h = F.crc32(F.concat("doc", F.lit(":"), "word").cast("binary"))
        runs = runs.select(h.alias("h"), "word").select(F.when(F.col("h") % damage == 0, F.expr(
            "concat(left(word, cast(h % length(word) AS int)), substr(word, cast(h % length(word) AS int) + 2))"))
            .otherwise(F.col("word")).alias("word")).filter(F.length("word") >= least_length)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def gram_order(words: DataFrame) -> dict[str, int]:
    """Each bigram's number of occurrences in distinct words, from rare to common; ties
    in code-point order. LETTERS bounds their number, and so what is collected."""
    grams = F.expr(f"transform(sequence(1, length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))")
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return {r["gram"]: r["n"] for r in sorted(counts.collect(), key=lambda r: (r["n"], r["gram"]))}


def pivots(grams: Sequence[tuple[int, int]], k: int = EDITS + 1) -> tuple[int, ...]:
    """Places of the ``k`` disjoint grams of least total cost out of (place, cost) in the
    order of places. ready[j] is the best choice of j grams that end before the next
    one begins; choices that end later wait until it does."""
    ready: list[tuple[int, tuple[int, ...]] | None] = [(0, ()), *[None] * k]
    waiting: list[tuple[int, int, tuple[int, tuple[int, ...]]]] = []

    def settle(before: float) -> None:
        while waiting and waiting[0][0] < before:
            _, j, choice = waiting.pop(0)
            held = ready[j]
            if held is None or choice < held:
                ready[j] = choice

    for place, cost in grams:
        settle(place - GRAM + 1)
        for j in range(k):
            held = ready[j]
            if held is not None:
                waiting.append((place, j + 1, (held[0] + cost, (*held[1], place))))
    settle(float("inf"))
    if ready[k] is None:
        raise ValueError("a word is too short for disjoint grams")
    return ready[k][1]


class Grams:
    """Prefix and pivots of words under one order of all grams."""

    def __init__(self, counts: Mapping[str, int]) -> None:
        self.counts = counts
        self.rank = {g: r for r, g in enumerate(counts)}

    def prefix(self, word: str) -> tuple[int, list[int]]:
        """Rank of the last gram of the prefix, and the places of its grams."""
        ranks = [self.rank[word[i:i + GRAM]] for i in range(len(word) - GRAM + 1)]
        last = sorted(ranks)[GRAM * EDITS]
        return last, [i for i, r in enumerate(ranks) if r <= last]

    def index(self, word: str) -> list[str]:
        """Keys that the word is found by: those of each gram of its prefix, read from
        the left and from the right."""
        size, out = len(word), []
        for p in self.prefix(word)[1]:
            out += side_keys("<", word, p, size) + side_keys(">", word[::-1], size - p - GRAM, size)
        return out

    def probe(self, word: str) -> list[str]:
        """Keys that its pivots look up: the other word has one letter less, as many or one more."""
        size, out = len(word), []
        for p in pivots([(p, self.counts[word[p:p + GRAM]]) for p in self.prefix(word)[1]]):
            for side, text, at in (("<", word, p), (">", word[::-1], size - p - GRAM)):
                for other in range(size - EDITS, size + EDITS + 1):
                    if at + GRAM < size or other > size:  # there is something on the other side to edit
                        out += side_keys(side, text, at, other)
        return out


def side_keys(side: str, text: str, p: int, size: int) -> list[str]:
    """Keys of the gram at place ``p`` for an indexed word of ``size`` letters. ``text`` is
    that word, or one that is the same up to the gram and one edit apart behind it. What
    stands behind it in the indexed word is cut into PARTS parts; a key leaves one out."""
    start, rest, behind = p + GRAM, size - p - GRAM, len(text) - size
    if rest < 2:
        return [f"{side}{size}{text[:start]}"] if rest >= 0 else []
    n, out = min(PARTS, rest), []
    for k in range(n):
        a, b = start + rest * k // n, start + rest * (k + 1) // n
        out.append(f"{side}{size}{text[:a]}-{text[b + behind:]}")
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of ``words`` (word, n) that differ by exactly one
    inserted, deleted or replaced code point, each pair once. Words have four letters
    of LETTERS at least."""
    grams = Grams(gram_order(words))

    def keyed(kind: str, word: str, n: str) -> DataFrame:
        def run(batches):
            keys_of = getattr(grams, kind)
            for batch in batches:
                keys = [[xxhash.xxh3_64_intdigest(k) for k in keys_of(w)] for w in batch.column(0).to_pylist()]
                sizes = np.fromiter(map(len, keys), dtype=np.int64, count=len(keys))
                flat = np.fromiter(chain.from_iterable(keys), dtype=np.uint64, count=int(sizes.sum())).view(np.int64)
                of = pa.array(np.repeat(np.arange(len(keys)), sizes))
                yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column(0).take(of), batch.column(1).take(of)], ["key", word, n])

        return words.select("word", "n").mapInArrow(run, f"key long, {word} string, {n} long")

    with arrow_rows(words.sparkSession, 2_000):
        found = keyed("probe", "a", "n_a").join(keyed("index", "b", "n_b"), "key").filter(
            (F.col("a") != F.col("b")) & (F.levenshtein("a", "b", EDITS) == EDITS))
        first, least, other = F.col("a") < F.col("b"), F.least("a", "b"), F.greatest("a", "b")
        return staged(found.select(
            least.alias("a"), F.when(first, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
            other.alias("b"), F.when(first, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")).distinct(), "spelling-pairs")


def spelling_forms(words: DataFrame, *, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    The form is the near word of largest n, ties to the smallest in code-point order,
    if that is ``times`` times the word's n; the root is the last form on the way.
    Words without near words have none and are their own root; no words give an
    empty result."""
    prepare(words.sparkSession)
    words = staged(words.select("word", "n"), "spelling-words")
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    chosen: Column = -F.col("best.rank") >= times * F.col("n")
    rows = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, -F.col("best.rank")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(chain: DataFrame) -> DataFrame:
    """(word, root): each word's last form. Every step is to a word at least TIMES as
    frequent, so chains are short; each round doubles what a word has passed."""
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(attach(chain, further, ["root"], "word", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        chain = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return chain


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE,
                      least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """spelling_forms of the words of ``docs``. Null and empty texts have no words;
    repeated rows count again; other columns are ignored; an empty table gives an
    empty result. ``least_length`` is four at least."""
    if least_length < GRAM * (EDITS + 1):
        raise ValueError("words need two disjoint bigrams")
    words = word_counts(docs, id_col=id_col, text_col=text_col, damage=damage, least_length=least_length,
                        least_count=least_count)
    return spelling_forms(words, times=times)
