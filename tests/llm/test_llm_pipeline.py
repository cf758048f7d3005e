"""The pipeline against a brute-force version, the registry and its guard."""

import subprocess
import sys
from pathlib import Path

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

ROOT = Path(__file__).resolve().parents[2]


def test_pipeline_is_its_stages_by_brute_force(spark, small):
    import corpus_pipeline as p
    from greenledger.llm import queries, toxicity
    from test_llm_dedup import lower, near_brute

    got = {r.doc_id: r.n_tokens for r in p.run(spark, "/root/testdata/sf0.01").collect()}
    model = toxicity.fit_toxicity(small("documents"), small("labels"))
    lexicon = toxicity.Lexicon(model.terms)
    rows = small("documents").collect()
    score = dict(zip((r.doc_id for r in rows), model.scores([r.text or "" for r in rows], lexicon), strict=True))
    clean = [r for r in rows if score[r.doc_id] < queries.TOXIC_FROM]
    last = {}
    for r in clean:
        last[lower(r.text)] = max(last.get(lower(r.text), -1), r.doc_id)
    single = [(r.doc_id, r.text) for r in clean if last[lower(r.text)] == r.doc_id]
    near = near_brute(single, 5)
    kept = [(i, t) for i, t in single if near[i][1] == i]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in kept}


def test_the_result_has_the_places_of_the_mix(spark, small):
    import corpus_pipeline as p
    from greenledger.llm import mixing
    from test_llm_web import mix_brute

    got = p.run(spark, "/root/testdata/sf0.01").collect()
    source = {r.doc_id: r.source for r in small("documents").collect()}
    rows = [(r.doc_id, f"={source[r.doc_id]}" if source[r.doc_id] is not None else "") for r in got]
    sizes = {s: sum(t == s for _, t in rows) for _, s in rows}
    blocks = {s: -(-n // mixing.BLOCK) for s, n in sizes.items()}
    shares = mixing.run_shares({s: n ** 0.5 for s, n in sizes.items()}, blocks, mixing.CYCLE)
    want = mix_brute(rows, shares, mixing.BLOCK)
    for s in sizes:
        places = sorted(r.place for r, (_, t) in zip(got, rows, strict=True) if t == s)
        assert places == sorted(at for (t, _), at in want.items() if t == s)
    assert len({r.place for r in got}) == len(got)
    assert all(r.slot == r.place // mixing.BLOCK for r in got)


def test_places_of_rows_without_an_id_of_their_own(spark, documents):
    import corpus_pipeline as p

    rows = [(i, f"t {i}", "a" if i % 3 else "b") for i in range(60)] + [(0, "u", "a"), (None, "v", "b"), (None, "w", "a")]
    got = p.encode(spark, documents(rows), "").collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(r[0] or 0 for r in rows)
    assert len({r.place for r in got}) == 61 and all(r.place is not None and r.slot == r.place // 8 for r in got)


def test_stages_keep_columns_and_bear_odd_rows(spark, documents, tmp_path):
    import corpus_pipeline as p

    (tmp_path / "sf").mkdir()
    base = documents([(1, "you idiot " * 5), (2, "calm words here " * 4)], extra=False)
    base.write.parquet(str(tmp_path / "sf/documents.parquet"))
    spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "sf/labels.parquet"))
    rows = [(1, None), (2, ""), (3, "Same text here"), (4, "same text here"), (4, "same text here"), (None, "n"), (None, "n"),
            (5, "w " * 20000)]
    for data, left in ((rows, {2, 4, None, 5}), ([], set())):
        docs = documents(data)
        for name, stage in p.STAGES:
            out = stage(spark, docs, str(tmp_path / "sf"))
            if name != p.STAGES[-1][0]:
                assert out.columns == docs.columns, name
                docs = out
        assert {r.doc_id for r in out.collect()} == left
        assert out.count() == len(left)


def test_registered_queries_match_their_sql(spark):
    import __spark_entry__ as entry

    named = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in named) for k in range(1, 14)] == [1] * 13 and "pipeline" in named
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    from greenledger.llm import queries

    for name, sql in queries.oracle_sql().items():
        got = named[name](spark, sf)
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(want, key=repr), name


def test_the_rest_imports_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, *_):
        if name == "corpus_pipeline" or name.startswith("greenledger.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = e.queries()
assert "kpi_trir" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names
assert "kpi_trir" in e.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
