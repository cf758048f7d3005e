"""Spelling variants against brute force and the query's SQL."""

import random
import re
import string
import zlib
from collections import Counter

import duckdb
import pytest

from greenledger.llm import queries, spelling


def damaged(doc_id, run):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % 31 == 0 else run


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(words):
    out = {}
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = (form, n, len(found), words[form] if form else None)

    def root(w):
        return w if out[w][0] is None else root(out[w][0])

    return sorted((w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items())


def brute_words(rows):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    runs = [(i, r.translate(low)) for i, t in rows for r in re.findall("[A-Za-zÀ-ÿ]+", t or "")]
    return {w: n for w, n in Counter(damaged(i, r) for i, r in runs).items() if n >= 2 and len(w) >= 7}


def collected(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def random_words(seed, n, letters):
    """Words with many neighbours, repeated bigrams and all kinds of edits."""
    rng, words = random.Random(seed), Counter()
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(n)]
    for s in stems:
        words[s] += rng.choice((2, 30, 900))
        for _ in range(rng.randint(0, 6)):
            i, c = rng.randrange(len(s) + 1), rng.choice(letters)
            t = rng.choice((s[:i] + c + s[i:], s[:i] + s[i + 1:], s[:i] + c + s[i + 1:]))
            if len(t) >= 7:
                words[t] += rng.randint(2, 40)
                s = rng.choice((s, t))
    return dict(words)


@pytest.mark.parametrize("letters", ["ab", "abcdefgé", string.ascii_lowercase])
def test_forms_are_brute_force(spark, letters):
    words = random_words(len(letters), 60, letters)
    got = spelling.spelling_forms(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert collected(got) == brute(words)


def test_pivots_are_the_cheapest_disjoint_grams():
    rng = random.Random(4)
    for _ in range(300):
        places = sorted(rng.sample(range(9), rng.randint(3, 7)))
        grams = [(p, rng.randint(1, 9)) for p in places]
        pairs = [(a + b, p, q) for p, a in grams for q, b in grams if q - p >= 2]
        found = spelling.pivots(grams)
        costs = dict(grams)
        assert found[1] - found[0] >= 2
        assert sum(costs[p] for p in found) == min(pairs)[0]
    with pytest.raises(ValueError):
        spelling.pivots([(0, 1), (1, 1)])


def test_variants_of_documents(spark, documents):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("Recieved!", "received", "RECEIVED", "receivéd", "×eceived", "environment", "enviroment", "short"))
                         for _ in range(60))) for i in range(40)]
    rows += [(None, None), (7, ""), (8, "received " * 5000), (8, "received " * 5000), (None, "received enviroment"), (9, "a" * 30000)]
    got = spelling.spelling_variants(documents(rows))
    assert collected(got) == brute(brute_words(rows))
    assert collected(spelling.spelling_variants(documents([]))) == []
    assert collected(spelling.spelling_variants(documents([(1, None), (2, "no long ones")]))) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(documents(rows), least_length=3)


def test_query_is_its_sql(spark, small):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS FROM '/root/testdata/sf0.001/documents.parquet'")
    got = queries.op11_spelling(spark, "/root/testdata/sf0.001")
    names = got.columns
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()['op11_spelling']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    texts = [(r.doc_id, r.text) for r in small("documents", "/root/testdata/sf0.001").collect()]
    assert {r[0]: r[3] for r in want} == brute_words(texts)
