"""The pipeline against a brute-force run of its stages, and the optional registration."""
import subprocess
import sys
import os

import corpus_pipeline as P
from test_decontaminate import plain as plain_hits
from test_mixing import plain_mix
from test_simhash import plain_fingerprint, plain_groups

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def folder(spark, scratch, rows, items):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch


def test_stages_against_brute_force(spark, scratch):
    import duckdb
    rows = duckdb.sql("select * from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    items = duckdb.sql("select * from '/root/testdata/sf0.001/benchmark.parquet'").fetchall()
    rows += [(9000, None, "en", "src1", 0), (9001, "123 !!", "en", "src1", 6), (9002, rows[0][1], None, None, 5), rows[0], (None, rows[1][1], "fr", "src2", 1),
             (9003, "Intro words. " + items[0][1] + " and the end.", "en", "src3", 9), (9004, "the lonely text of nobody", None, None, None)]
    d = folder(spark, scratch, rows, items)
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), rows
    outs = []
    for k, (_, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, d)
        path = f"{d}/out{k}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        outs.append([tuple(r) for r in docs.collect()])
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    key = lambda r: str(r)
    want = [r for r in seen if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(outs[0], key=key) == sorted(want, key=key)
    groups = plain_groups([plain_fingerprint(r[1]) for r in want])
    kept = {}
    for r, g in zip(want, groups):
        if g not in kept or (r[0] is None, r[0] or 0) < (kept[g][0] is None, kept[g][0] or 0):
            kept[g] = r
    assert sorted(outs[1], key=key) == sorted(kept.values(), key=key)
    want = [r for r in kept.values() if not plain_hits([(r[0], r[1])], items)[0][5]]
    assert sorted(outs[2], key=key) == sorted(want, key=key) and 9003 not in {r[0] for r in want}
    mixed = plain_mix([(r[0], r[1], r[3]) for r in want], 16, 256)
    times = {i: (2 * t + n) // (2 * n) for i, n, _, _, t in mixed}
    assert sorted(outs[3], key=key) == sorted((r for r in want for _ in range(times[r[0]])), key=key)
    assert [r[:5] for r in sorted(outs[4], key=key)] == sorted(outs[3], key=key)
    assert sorted(map(tuple, P.run(spark, d).collect()), key=key) == sorted(outs[4], key=key)


def test_empty_and_odd_tables(spark, scratch):
    d = folder(spark, scratch, [], [])
    assert P.run(spark, d).count() == 0


def test_import_errors_are_not_hidden_in_the_pipeline():
    code = "import sys; sys.modules['tokenmill.llm'] = None\ntry:\n    import corpus_pipeline\nexcept ImportError:\n    print('raised')"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert "raised" in out.stdout
    code = ("import sys; sys.modules['tokenmill.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "q = e.queries(); print(not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q and 'pieces' in q)")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert "True" in out.stdout, out.stderr
