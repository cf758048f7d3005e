"""K-d tree shards against a plain recursion, and written shards."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from greenledger.llm import kd_shards, queries


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def sample(seed, n):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.choice((0, 3, 50, 400)), rng.choice(("en", "de", None)), "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 9)}",
             rng.randint(0, 400)) for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "y" * 20, "en", "hot", 20), (5, "dup", "en", "hot", 3), (5, "dup", "en", "hot", 3)]


def plain(rows, shards):
    """Shard of each row by recursion over lists."""
    def number(x):
        return 0.0 if x is None else float(int(x.encode()[:6].hex().ljust(12, "0") or "0", 16))

    raw = [(number(r[3]), number(r[2]), float(r[4] or 0)) for r in rows]
    missing = [(r[3] is None, r[2] is None, r[4] is None) for r in rows]
    ends = [([x[k] for x, m in zip(raw, missing, strict=True) if not m[k]] or [0.0]) for k in range(3)]
    at = [tuple(0.0 if m[k] or max(ends[k]) == min(ends[k]) else (x[k] - min(ends[k])) / (max(ends[k]) - min(ends[k]))
                for k in range(3)) for x, m in zip(raw, missing, strict=True)]
    size = [len((r[1] or "").encode()) + 1 for r in rows]
    out = [0] * len(rows)

    def cut(items, first, leaves):
        if leaves == 1 or not items:
            for i in items:
                out[i] = first
            return
        wide = [max(at[i][k] for i in items) - min(at[i][k] for i in items) for k in range(3)]
        axis = wide.index(max(wide))
        items = sorted(items, key=lambda i: (at[i][axis], at[i], rows[i][0] is not None, rows[i][0] or 0, i))
        total, before, left, sides = sum(size[i] for i in items), 0, leaves // 2, ([], [])
        for i in items:
            sides[(2.0 * before + size[i]) * leaves > 2.0 * total * left].append(i)
            before += size[i]
        cut(sides[0], first, left)
        cut(sides[1], first + left, leaves - left)

    cut(list(range(len(rows))), 0, shards)
    return Counter((r[0], s, zlib.crc32((r[1] or "").encode()), o) for r, s, o in zip(rows, size, out, strict=True))


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_shards_are_those_of_the_recursion(spark, shards):
    rows = sample(shards, 400)
    got = kd_shards.kd_shards(made(spark, rows).coalesce(1), shards).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in got) == plain(rows, shards)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        ids = [r.doc_id for r in sorted((r for r in got if r.shard == s), key=lambda r: r.slot)]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_sizes_are_near_equal_with_a_hot_value(spark):
    rows = [(i, "z" * (i % 97), "en", "one", 7) for i in range(3000)]
    got = kd_shards.kd_shards(made(spark, rows), 16).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    mean = sum(r.b for r in got) / 16
    assert len(got) == 16 and all(abs(r.b - mean) <= 97 for r in got)


def test_target_bytes_and_edges(spark, documents):
    rows = [(i, "w" * 99) for i in range(50)]
    got = kd_shards.kd_shards(documents(rows), target_bytes=1000).collect()
    assert Counter(r.shard for r in got) == dict.fromkeys(range(5), 10)
    assert kd_shards.kd_shards(documents([]), 16).collect() == []
    assert kd_shards.kd_shards(documents([]), target_bytes=10).collect() == []
    few = kd_shards.kd_shards(documents([(1, "a" * 100000), (2, None), (None, "")]), 16).collect()
    assert len(few) == 3 and all(0 <= r.shard < 16 for r in few)
    with pytest.raises(ValueError):
        kd_shards.kd_shards(documents(rows))


def test_written_shards_hold_all_rows(spark, documents, tmp_path):
    rows = [(i, "t" * (i % 13), f"s{i % 3}") for i in range(60)] + [(None, "n1"), (None, "n2"), (4, "again")]
    docs = documents(rows)
    placed = kd_shards.write_shards(docs, str(tmp_path / "out"), 4).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*docs.columns, "_shard"])
    assert Counter((r.doc_id, r.text, r._salt) for r in back.collect()) == Counter((r[0], r[1], "clash _salt") for r in rows)
    first = {}
    for r in placed:
        first[r.doc_id] = min(first.get(r.doc_id, (99, 0)), (r.shard, r.slot))
    assert all(first[r.doc_id][0] == r._shard for r in back.collect())
    with pytest.raises(ValueError):
        kd_shards.write_shards(docs, str(tmp_path / "no"), 4, folder_col="text")


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS FROM '/root/testdata/sf0.001/documents.parquet'")
    got = queries.op12_kd_shards(spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()['op12_kd_shards']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
