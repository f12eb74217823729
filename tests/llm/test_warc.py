"""Revisit resolution against a plain walk through the captures."""
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tokenmill.llm import warc as W

T0 = datetime(2024, 1, 1)
SCHEMA = "record_id long, url string, ts timestamp, status int, etag string, last_modified string, headers map<string,string>, body string, outcome string"


def plain(rows, canon):
    out = []
    key = lambda r: (r[2] is not None, r[2] or T0, r[0])
    for r in rows:
        if r[3] == 200:
            out.append((r[0], r[0], "full", r[7], r[6]))
            continue
        if r[3] != 304:
            out.append((r[0], None, "other", r[7], r[6]))
            continue
        before = [x for x in rows if x[3] == 200 and canon[r[1]] is not None and canon[x[1]] == canon[r[1]] and key(x) < key(r)]
        if not before:
            out.append((r[0], None, "orphan", r[7], r[6]))
            continue
        full = max(before, key=key)
        strip = lambda e: e[2:] if e.startswith("W/") else e
        if r[4] is not None and full[4] is not None:
            fits = "resolved" if strip(r[4]) == strip(full[4]) else "mismatch"
        elif r[5] is not None and full[5] is not None:
            fits = "resolved" if r[5] == full[5] else "mismatch"
        else:
            fits = "unvalidated"
        if fits == "resolved":
            merged = dict(full[6] or {}) | {k: v for k, v in (r[6] or {}).items() if k not in W.NOT_MERGED}
            out.append((r[0], full[0], fits, full[7], merged))
        else:
            out.append((r[0], full[0], fits, r[7], r[6]))
    return sorted(out, key=str)


def test_canonical_urls(spark):
    same = ["http://www.a.com/x/", "https://A.com:443/x?utm_source=f#top", "http://a.com/x?ref=1", "https://a.com/x"]
    other = ["http://a.com/X", "http://b.a.com/x", "http://a.com/x?q=1", None, "relative/x", ""]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in same + other], "u string").select(W.canonical_url(F.col("u"))).collect()]
    assert len(set(got[:4])) == 1 and got[0] not in got[4:] and got[7:] == [None, None, None]
    two = [r[0] for r in spark.createDataFrame([("http://a.com/?b=2&a=1",), ("http://a.com?a=1&b=2",)], "u string").select(W.canonical_url(F.col("u"))).collect()]
    assert two[0] == two[1]


def test_against_a_plain_walk(spark):
    rng = random.Random(4)
    urls = ["http://hot.com/a", "https://www.hot.com/a/", "http://hot.com/a?utm_source=z", "http://c.com/", "http://d.org/x?y=1", None, "bad"]
    rows = []
    for i in range(400):
        url = rng.choice(urls[:3] * 4 + urls)
        ts = rng.choice([None] + [T0 + timedelta(hours=rng.randint(0, 60))] * 20)
        status = rng.choice([200, 304, 304, 304, 404, None])
        tag = rng.choice([None, '"1"', '"2"', 'W/"1"'])
        headers = rng.choice([None, {}, {"date": f"d{i}", "content-length": str(i)}, {"etag": "e", "vary": "*"}])
        rows.append((i, url, ts, status, tag, rng.choice([None, "m1", "m2"]), headers, f"body{i}" if status == 200 else None, "mine"))
    df = spark.createDataFrame(rows, SCHEMA)
    canon = {r["url"]: r["k"] for r in df.select("url", W.canonical_url(F.col("url")).alias("k")).distinct().collect()}
    for seconds in (3600, W.SLICE_SECONDS, 10 ** 9):
        out = W.resolve_revisits(df, payload=("body",), slice_seconds=seconds)
        got = sorted(((r["record_id"], r["refers_to"], r["outcome"], r["body"], r["headers"]) for r in out.collect()), key=str)
        assert [g[:4] for g in got] == [w[:4] for w in plain(rows, canon)]
        assert {g[0]: g[4] for g in got} == {w[0]: w[4] for w in plain(rows, canon)}
    assert out.columns == ["record_id", "url", "ts", "status", "etag", "last_modified", "headers", "body", "refers_to", "outcome"]


def test_repeated_and_empty(spark):
    row = (1, "http://a.com/", T0, 200, '"x"', None, None, "b", "o")
    rev = (2, "http://a.com/", T0 + timedelta(days=9), 304, 'W/"x"', None, {"date": "d"}, None, "o")
    out = W.resolve_revisits(spark.createDataFrame([row, row, rev, rev], SCHEMA), payload=("body",)).collect()
    assert sorted((r["record_id"], r["outcome"], r["body"], r["refers_to"]) for r in out) == [(1, "full", "b", 1)] * 2 + [(2, "resolved", "b", 1)] * 2
    assert W.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_columns_with_any_name(spark):
    """Inner names, dots and payloads of any name come back as they were."""
    schema = SCHEMA.replace("body string", "`__p1.x` string") + ", __key string, __slice int, __near string, __found string, __rest int, `a.b` int, p0 string"
    full = (1, "http://a.com/", T0, 200, '"x"', None, None, "b", "o", "keep", 7, "n", "f", 3, 5, "p")
    again = (2, "http://a.com/", T0 + timedelta(days=9), 304, 'W/"x"', None, {"date": "d"}, None, "o", "mine", 8, None, "g", 4, 6, None)
    df = spark.createDataFrame([full, again], schema)
    out = W.resolve_revisits(df, payload=("__p1.x", "p0")).orderBy("record_id").collect()
    assert list(out[0].asDict()) == [c for c in df.columns if c != "outcome"] + ["refers_to", "outcome"]
    assert tuple(out[0])[7:] == ("b", "keep", 7, "n", "f", 3, 5, "p", 1, "full")
    assert tuple(out[1])[7:] == ("b", "mine", 8, None, "g", 4, 6, "p", 1, "resolved")
