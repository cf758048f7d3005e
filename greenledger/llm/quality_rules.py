"""Quality rules by repetition coverage.

Words become numbers in order of first use, and a rolling hash runs over them
for several n-gram lengths at once: the hash of n + 1 words is that of n words
times a constant plus the next word. Sorting the hashes shows which n-grams
occur twice; the characters inside them, and inside repeated lines, are
measured against all characters of the words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

#: Share of characters in the most frequent n-gram, and share of
#: characters inside n-grams that occur twice or more, above which a text fails
#: (the limits of published repetition filters for web text).
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
REPEAT_LIMITS = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; a text fails a rule above its limit. The shares of
    symbols and repeated lines are rules of the base measures."""

    least_words: int = 10
    repeat_words_pct: int = 20
    line_share: float = 0.50
    line_char_share: float = 0.30
    symbol_share: float = 0.05
    upper_share: float = 0.50


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(ids: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit number for each small number."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
    x ^= x >> np.uint64(32)
    x *= _OTHER
    x ^= x >> np.uint64(29)
    return x


def repeated_windows(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of windows with hashes h: which occur twice or more, and the order of equal
    ones with the starts of their runs in it."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    sizes = np.diff(np.r_[starts, len(s)])
    again = np.zeros(len(h), dtype=bool)
    again[order] = np.repeat(sizes > 1, sizes)
    return again, order, starts


def covered(mask: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside a marked window of n words."""
    ends = np.zeros(words + 1, dtype=np.int64)
    at = np.flatnonzero(mask)
    np.add.at(ends, at, 1)
    np.add.at(ends, at + n, -1)
    return np.cumsum(ends[:-1]) > 0


def measure(text: str, rules: Rules = Rules()) -> dict:
    """All measures and the verdict for one whole text."""
    words = text.encode().split()  # bytes.split() knows the six ASCII spaces only
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    seen: set[str] = set()
    repeats = [x for x in lines if x in seen or seen.add(x)]
    out = {"n_words": n, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": len(repeats),
           "n_repeat_words": 0, "repeat_chars": 0, "top_chars": 0}
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    chars = np.array([len(w.decode()) for w in numbers], dtype=np.int64)[ids] if n else ids
    upto = np.r_[0, np.cumsum(chars)]
    x = word_hashes(ids)
    h, failed = x, False
    for k in range(2, max(REPEAT_LIMITS) + 1):
        if k > n:
            break
        h = h[:n - k + 1] * _MULTIPLIER + x[k - 1:]
        if k in TOP_LIMITS or k in REPEAT_LIMITS:
            again, order, starts = repeated_windows(h)
            if not again.any():
                break  # then no longer n-gram occurs twice either
            if k in TOP_LIMITS:
                size = upto[k:] - upto[:-k]
                whole = np.add.reduceat(size[order], starts)
                # overlapping occurrences must not count a character twice
                best = order[starts[whole == whole.max()]].min()  # of equal ones the first
                top = int(chars[covered(h == h[best], k, n)].sum())
                out["top_chars"] = max(out["top_chars"], top)
                failed |= top > TOP_LIMITS[k] * word_chars and n > 2 * k and (h == h[best]).sum() > 2
            if k in REPEAT_LIMITS:
                inside = covered(again, k, n)
                here = int(chars[inside].sum())
                if k == 5:
                    out["n_repeat_words"] = int(inside.sum())
                out["repeat_chars"] = max(out["repeat_chars"], here)
                failed |= here > REPEAT_LIMITS[k] * word_chars
    out["base_failed"] = n < rules.least_words or 100 * out["n_repeat_words"] > rules.repeat_words_pct * n
    if lines:
        failed |= len(repeats) > rules.line_share * len(lines)
        failed |= sum(map(len, repeats)) > rules.line_char_share * sum(map(len, lines))
    failed |= symbols > rules.symbol_share * word_chars
    failed |= sum(map(str.isupper, text)) > rules.upper_share * max(1, word_chars)
    out["kept"] = not out["base_failed"] and not failed
    return out


def quality_rules(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document with the measures and the verdict ``kept``.

    A null or empty text has no words and fails; rows with a null or repeated id
    stay rows of their own; other columns are ignored. One narrow pass."""
    prepare(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    flags, more = ["base_failed", "kept"], ["repeat_chars", "top_chars"]

    def run(batches):
        for batch in batches:
            found = [measure(t or "", rules) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f[c] for f in found], pa.bool_() if c in flags else pa.int64())
                       for c in [*longs, *flags, *more]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *longs, *flags, *more])

    kinds = [f"{c} long" for c in longs] + [f"{c} boolean" for c in flags] + [f"{c} long" for c in more]
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(kinds))
