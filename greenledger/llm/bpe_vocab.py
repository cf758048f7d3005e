"""A public byte-level BPE vocabulary: parsing, the splitting pattern and the
merge of one fragment. The file's content reaches the executors as a broadcast
variable, bounded by the size of the vocabulary (a few MB)."""

from __future__ import annotations

import heapq
import json

import public_tokenizers
import regex

#: Longest fragment, in bytes, that is merged by plain rescanning.
SHORT = 48

#: Entries a worker remembers before it starts anew, and their longest key.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64

#: Above every rank: a pair that does not merge.
NEVER = 1 << 30


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def byte_chars() -> list[str]:
    """The character that stands for each byte in the vocabulary file: itself
    if printable and not a space, else one of the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Remembered(dict):
    """Values of a function by key, up to a bound; then it starts anew."""

    def __init__(self, make) -> None:
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """Ids and merges of a byte-level BPE file. ``first[b]`` is the id of byte
    b; ``ranks[(left, right)]`` is a merge's rank, ``made[rank]`` the id that it
    makes; ``bytes_of[id]`` are the bytes."""

    def __init__(self, raw: bytes) -> None:
        spec = json.loads(raw)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        chars = byte_chars()
        to_byte = {c: b for b, c in enumerate(chars)}
        ids = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()
                         if t not in self.specials}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.specials.items()}
        self.first = [ids[c] for c in chars]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.longest = max(map(len, self.id_of))
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.special = (regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
                        if self.specials else None)

    def runs(self, text: str):
        """(text between special tokens, id of the special that follows or None)."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield text[at:m.start()], self.specials[m[0]]
            at = m.end()
        yield text[at:], None

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of one fragment: always the lowest rank first, leftmost on ties."""
        ids = [self.first[b] for b in fragment]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, made = self.ranks.get, self.made
        ranks = [rank_of(pair, NEVER) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            at = ranks.index(best)
            ids[at:at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, in n log n for long fragments."""
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (pair := (ids[left], ids[right])) in ranks:
                    heapq.heappush(heap, (ranks[pair], left, *pair))
        return [x for x in ids if x >= 0]


_LOADED: dict[tuple[type, int, int], object] = {}


def loaded(kind: type, raw: bytes):
    """One instance of ``kind`` per Python worker and vocabulary."""
    key = (kind, len(raw), hash(raw))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = kind(Vocabulary(raw))
    return _LOADED[key]
