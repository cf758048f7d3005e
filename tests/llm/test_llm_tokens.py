"""BPE codec and token counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from greenledger.llm import bpe_codec, token_counts
from greenledger.llm.bpe_vocab import SHORT, Vocabulary, vocabulary_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  \n\n x  ", "it's 'll 'LL 're don't'tt", "<|endoftext|>hi <|endoftext|>", "<|endof", "a" * 3000, "ab" * 700,
       "\u0085a b　c​", "éé²½ Ⅷ 三 12٣", "\U0001f642\U0001f642 \U0001f642", " " * 300 + "x",
       "x" + "\t" * 100, "\x00\x01 ﻿", "The quick brown fox's 1234567 jumps!!!\r\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(vocabulary_bytes(PATH))


def texts(small):
    rng = random.Random(3)
    made = ["".join(rng.choice("ab '\n\tltse1é.\U0001f642") for _ in range(40)) for _ in range(200)]
    return ODD + made + [r.text for r in small("documents", "/root/testdata/sf0.001").collect()]


def test_codec_is_the_library(library, vocabulary, small):
    codec = bpe_codec.Codec(vocabulary)
    for text in texts(small):
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(codec.encode(text)) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_character_class_is_the_librarys(library, vocabulary):
    codec = bpe_codec.Codec(vocabulary)
    probes = [f"a{chr(c)}1{chr(c)}{chr(c)}b" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for probe, found in zip(probes, library.encode_batch(probes, add_special_tokens=False), strict=True):
        assert list(codec.encode(probe)) == found.ids


def test_fragments_encode_independently(vocabulary):
    codec = bpe_codec.Codec(vocabulary)
    rng = random.Random(1)
    cuts = 0
    for _ in range(500):
        piece = bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyzQXZ!?.") for _ in range(rng.randint(1, 60)))
        parts = codec.cut(piece)
        cuts += len(parts) - 1
        assert b"".join(parts) == piece
        assert sum(map(vocabulary.merge, parts), []) == vocabulary.merge(piece)
    assert cuts > 500


def test_short_and_long_merges_agree(vocabulary):
    rng = random.Random(2)
    for size in (1, 2, SHORT, SHORT + 1, 200):
        raw = bytes(rng.choice(b"theraoin ") for _ in range(size))
        ids = [vocabulary.first[b] for b in raw]
        assert vocabulary._merge_short(list(ids)) == vocabulary._merge_long(list(ids))


def test_a_decoded_broken_sequence_is_replaced(vocabulary, library):
    ids = library.encode("\U0001f642é", add_special_tokens=False).ids[:-1]
    assert bpe_codec.Codec(vocabulary).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_encode_documents(spark, documents, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "x"), (99, None), (100, "lorem ipsum " * 20000)]
    got = bpe_codec.encode_documents(documents(rows), PATH)
    assert got.columns == ["doc_id", "n_tokens", "token_ids", "decoded"]
    found = sorted(map(tuple, got.collect()), key=repr)
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert found == sorted(((i, len(x), x, library.decode(x, skip_special_tokens=False))
                            for (i, _), x in zip(rows, ids, strict=True)), key=repr)
    back = bpe_codec.decode_documents(got, PATH)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, t or "") for i, t in rows}
    digests = {r.doc_id: r for r in bpe_codec.token_digests(documents(rows[:15]), PATH).collect()}
    for (i, _), x in zip(rows[:15], ids, strict=False):
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(
            library.decode(x, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_codec.token_digests(documents([]), PATH).collect() == []


def test_prefix_counts_are_exact(library, vocabulary, small):
    counter = token_counts.PrefixCounter(vocabulary)
    for text in texts(small)[:250]:
        text = text[:250]
        counts = counter.prefix_counts(text)
        found = library.encode_batch([text[:k] for k in range(len(text) + 1)], add_special_tokens=False)
        assert counts.tolist() == [len(x.ids) for x in found]
        assert counter.count(text) == counts[-1]
        for budget in (0, 1, 3, 10, 17):
            fit = int(np.flatnonzero(counts <= budget)[-1])
            assert counter.fitting(text, budget) == fit
            assert counter.measure(text, budget) == (counts[-1], fit)


def test_count_documents(spark, documents, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(5, ODD[5]), (None, "x y"), (77, None), (78, "a b " * 9000)]
    got = token_counts.count_documents(documents(rows), PATH, 512).collect()
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(want, key=repr)
    long = next(r for r in got if r.doc_id == 78)
    assert len(library.encode(rows[-1][1][:long.fit_chars], add_special_tokens=False).ids) <= 512
    assert len(library.encode(rows[-1][1][:long.fit_chars + 2], add_special_tokens=False).ids) > 512
    assert token_counts.count_documents(documents([]), PATH, 512).collect() == []
