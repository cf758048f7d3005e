"""Token counts by prefix dynamic programming.

For every prefix of a piece the table holds the last token of its encoding and
the number of tokens. A prefix of length i ends in the one vocabulary token t
whose predecessor (the last token of the prefix of length i - len(t)) and t
themselves encode as exactly these two; its count is that predecessor's count
plus one. The tokens that end at a place are found by one automaton over the whole
vocabulary, so a table takes time in proportion to its piece. Prefixes of whole
texts add the counts of the finished pieces, so truncation and budget questions
need no second encoding.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bpe_vocab import NEVER, Remembered, Vocabulary, loaded, vocabulary_bytes
from .common import prepare

_SPACE = regex.compile(r"\s+")


class PrefixCounter:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.parts, self.rank = self._parts()
        self.pairs = Remembered(self.follows)
        self.totals = Remembered(lambda piece: self.table(piece.encode())[-1])
        self.ending = ahocorasick.Automaton()
        for token, i in vocabulary.id_of.items():
            if i in self.rank:
                self.ending.add_word(token.decode("latin-1"), (i, len(token)))
        self.ending.make_automaton()

    def _parts(self) -> tuple[dict[int, tuple[int, int]], dict[int, int]]:
        """The two tokens that each token is merged from, and the rank of that merge
        (-1 for bytes), of tokens that their own bytes encode as. A merge is ranked
        after those of its parts, or the vocabulary is refused."""
        v = self.v
        parts, rank = {}, dict.fromkeys(v.first, -1)
        for (left, right), n in sorted(v.ranks.items(), key=lambda x: x[1]):
            made = v.made[n]
            if made not in rank and left in rank and right in rank and self._apart(left, right, parts, rank, n):
                parts[made], rank[made] = (left, right), n
                if max(rank[left], rank[right]) >= n:
                    raise ValueError("a merge is ranked before its parts")
        return parts, rank

    def _apart(self, left: int, right: int, parts, rank, limit: int) -> bool:
        """Whether no merge ranked below ``limit`` crosses the seam of two tokens. Going
        back in time, the token that was made last is taken apart; before that, the
        pair at the seam must not have been the better merge. Of equal ranks, the
        one further left is merged first."""
        while self.v.ranks.get((left, right), NEVER) >= limit:
            of_left, of_right = rank[left], rank[right]
            if of_left > of_right:
                limit, left = of_left, parts[left][1]
            elif of_right >= 0:
                limit, right = of_right + 1, parts[right][0]
            else:
                return True
        return False

    def follows(self, pair: tuple[int, int]) -> bool:
        """Whether the second token may follow the first within a piece; a first
        below 0 stands for the start."""
        left, right = pair
        return left < 0 or self._apart(left, right, self.parts, self.rank, NEVER)

    def table(self, piece: bytes) -> list[int]:
        """Token count of every prefix of a piece, by byte length, from 0 on."""
        follows, n = self.pairs, len(piece)
        counts, last = [0] * (n + 1), [-1] * (n + 1)
        for end, (token, size) in self.ending.iter(piece.decode("latin-1")):
            end += 1
            if not counts[end] and follows[last[end - size], token]:
                counts[end], last[end] = counts[end - size] + 1, token
        return counts

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        return sum(sum(map(self.totals.__getitem__, self.v.words.findall(run))) + (special is not None)
                   for run, special in self.v.runs(text))

    # A piece start after a character that is no white space is safe: whatever
    # ends a prefix beyond it, the pieces before it stay the same.

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token count of every prefix of a text, by number of characters, each as
        if the prefix were the whole text."""
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = done = 0
        for run, special in self.v.runs(text):
            done, safe, before = self._run_prefixes(run, done, out[at:])
            at += len(run)
            if special is not None:  # its name is plain text until it is whole
                name = self.v.bytes_of[special].decode()
                for p in range(1, len(name)):
                    out[at + p] = before + self.count(run[safe:] + name[:p])
                at, done = at + len(name), done + 1
                out[at] = done
        return out

    def _run_prefixes(self, run: str, done: int, out: np.ndarray) -> tuple[int, int, int]:
        """Fill in the counts of the prefixes of ``run`` after ``done`` tokens; the tokens at
        its end, its last safe start and the tokens there."""

        def fill(start: int, piece: str, skip: int = 0) -> None:
            table = np.array(self.table(piece.encode()))
            ends = np.arange(1, len(piece) + 1) if piece.isascii() else np.cumsum([len(c.encode()) for c in piece])
            out[start + 1 + skip:start + len(piece) + 1] = done + table[ends[skip:]]

        safe, before, spaced = 0, done, 0  # white space is filled in up to there
        for m in self.v.words.finditer(run):
            start, piece = m.start(), m[0]
            if start >= spaced and (space := _SPACE.match(run, start)):
                # wherever it is cut, white space at the end is one piece
                safe, before = start, done
                fill(start, space[0])
                spaced = space.end()
            elif start >= spaced:
                safe, before = start, done
            if m.end() > spaced:
                if piece[0] == "'" and piece[1:2].isalpha():  # a contraction is none until it is whole
                    for p in range(1, len(piece)):
                        out[start + p] = done + self.count(piece[:p])
                    out[m.end()] = done + self.totals[piece]
                else:
                    fill(start, piece, max(0, spaced - start))
            done += self.totals[piece]
        return done, safe, before

    def fitting(self, text: str, budget: int) -> int:
        """Characters of the longest prefix that takes at most ``budget`` tokens."""
        at = done = safe = before = 0
        end = len(text)
        for run, special in self.v.runs(text):
            spaced = 0
            for m in self.v.words.finditer(run):
                start = m.start()
                if start >= spaced:
                    if done > budget:
                        return self._last_within(text, safe, at + start, budget - before)
                    safe, before = at + start, done
                    if space := _SPACE.match(run, start):
                        spaced = space.end()
                done += self.totals[m[0]]
            at += len(run)
            if special is not None:
                at, done = at + len(self.v.bytes_of[special].decode()), done + 1
                if done > budget:
                    return self._last_within(text, safe, at, budget - before)
                safe, before = at, done
        return end if done <= budget else self._last_within(text, safe, end, budget - before)

    def _last_within(self, text: str, start: int, end: int, budget: int) -> int:
        """The last place from ``start``, a safe one, to ``end`` up to which the text takes at
        most ``budget`` tokens. Counts of prefixes can fall again, so all are asked."""
        return start + int(np.flatnonzero(self.prefix_counts(text[start:end]) <= budget)[-1])

    def measure(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of a whole text and, as :meth:`fitting`, the characters that fit."""
        if self.v.special and self.v.special.search(text):
            return self.count(text), self.fitting(text, budget)
        pieces = self.v.words.findall(text)
        totals = list(accumulate(map(self.totals.__getitem__, pieces)))
        if not totals or totals[-1] <= budget:
            return totals[-1] if totals else 0, len(text)
        k = bisect_right(totals, budget)  # the first piece that ends above the budget
        start = end = sum(map(len, pieces[:k]))
        safe = k
        while safe and text[start - 1].isspace():
            safe -= 1
            start -= len(pieces[safe])
        while k < len(pieces):
            end += len(pieces[k])
            k += 1
            if not text[end - 1].isspace():
                break
        return totals[-1], self._last_within(text, start, end, budget - (totals[safe - 1] if safe else 0))


def count_documents(docs: DataFrame, vocabulary: str, budget: int, *, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars) of every row, whole texts.
    ``fit_chars``: characters of the longest prefix within the budget. A null or
    empty text counts 0; rows with a null or repeated id stay rows of their own;
    other columns are ignored. One narrow pass, no shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    raw = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches):
        counter = loaded(PrefixCounter, raw.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [counter.measure(t, budget) for t in texts]
            tokens, fit = [n for n, _ in found], [f for _, f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > budget for n in tokens]), pa.array(fit, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
