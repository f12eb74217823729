"""URL rules: parsing, explicit rules, mining and matching against plain versions."""
import random
import time
from itertools import combinations

from pyspark.sql import functions as F

from tokenmill.llm import url_rules as U

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return host.translate(UP), rest[:end]


def plain_rule(host, path):
    best = None
    for verdict, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


URLS = ["http://a.com/x", "https://EXAMPLE.com/en/1", "https://www.Example.com/en/1?q=://z", "http://b.www.example.com/en/", "http://com", "http://com/",
        "http://net/es/1", "x://sub.net/fr/a#b", "http://notnet/es/", "ftp://xnet/fr/1", "http://example.com/EN/1", "http://example.com/en",
        "no scheme", "", None, "http://", "://h/p", "http://h?x/y", "http://É.net/es/ü", "http://a.com\n/x", "http://a.org/b://c/d?e", "HTTP://x.net/es",
        "http://u.com:80/", "http://q.org/" + "z" * 100_000]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)] + [(0, URLS[0], "again")], "page_id long, url string, verdict string")
    out = U.judge_urls(pages, spark.createDataFrame([], "url string, bad boolean"))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "confidence"] and out.count() == len(URLS) + 1
    for r in out.collect():
        host, path = split(r["url"])
        want = plain_rule(host, path)
        assert (r["host"], r["path"]) == (host, path), r["url"]
        assert (r["rule"], r["verdict"]) == (want or (None, "allow")), r["url"]


def labelled_urls():
    rng = random.Random(2)
    rows = []
    for i in range(400):
        host = rng.choice(["casino-win.org", "good.org", "blog.fine.org", "shop.org"])
        lang = rng.choice(["en", "de"])
        url = f"https://{host}/{lang}/{i}" + rng.choice(["", "?ref=x", "#top"])
        bad = host == "casino-win.org" or (host == "shop.org" and lang == "de" and rng.random() < 0.9) or rng.random() < 0.05
        rows.append((url, bad))
    return rows


def test_mining_and_matching_against_plain_counts(spark):
    rows = labelled_urls()
    rows_df = spark.createDataFrame(rows + [(None, True), ("http://x.org/", None)], "url string, bad boolean")
    tokens = {r["url"]: set(r["t"]) for r in rows_df.select("url", U.url_tokens(F.col("url")).alias("t")).collect()}
    rules = {tuple(r["tokens"]): r["confidence"] for r in U.mine_rules(rows_df, 0.05, 0.6).collect()}
    count, bad = {}, {}
    for url, b in rows:
        for n in (1, 2, 3):
            for c in combinations(sorted(tokens[url]), n):
                count[c] = count.get(c, 0) + 1
                bad[c] = bad.get(c, 0) + b
    base = sum(b for _, b in rows) / len(rows)
    want = {c: bad[c] / count[c] for c in count if bad[c] >= 0.05 * len(rows) and bad[c] / count[c] >= 0.6 and bad[c] / count[c] > base}
    want = {c: v for c, v in want.items() if not any(set(o) < set(c) and w >= v for o, w in want.items())}
    assert rules.keys() == want.keys() and all(abs(rules[c] - want[c]) < 1e-12 for c in want)

    fresh = ["http://casino-win.org/fr/9", "http://good.org/en/1", "https://shop.org/de/77", "https://shop.org/en/77", "http://other.org/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(fresh)], "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["confidence"]) for r in U.judge_urls(pages, rows_df, min_support=0.05, min_confidence=0.6).collect()}
    toks = {r["page_id"]: set(r["t"]) for r in pages.select("page_id", U.url_tokens(F.col("url")).alias("t")).collect()}
    for i in range(len(fresh)):
        fit = [v for c, v in want.items() if set(c) <= toks[i]]
        assert got[i] == (("block", max(fit)) if fit else ("allow", None))
    assert got[0][0] == "block" and got[1][0] == "allow" and got[2][0] == "block"


def test_index_by_shuffle_gives_the_same(spark, monkeypatch):
    rows_df = spark.createDataFrame(labelled_urls(), "url string, bad boolean")
    rules = U.mine_rules(rows_df, 0.05, 0.6)
    urls = rows_df.select("url").distinct()
    a = sorted(map(tuple, U.match_rules(urls, rules).collect()))
    monkeypatch.setattr(U, "BROADCAST_RULES", -1)
    assert a and sorted(map(tuple, U.match_rules(urls, rules).collect())) == a


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(pages, spark.createDataFrame(labelled_urls(), "url string, bad boolean")).count() == 0


def test_a_long_url_does_not_explode(spark):
    """Copies of a url of 200 segments, half of them bad, and another one all bad: rules in seconds, as by counting."""
    long = "http://a.b/" + "/".join(f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    rows = [(f"http://x{chr(97 + i % 26)}.org/p{chr(97 + i % 7)}/q", i % 9 == 0) for i in range(300)]
    rows += [(long, i % 2 == 0) for i in range(40)] + [(long.replace("a.b/s", "c.d/t"), True)] * 20
    start = time.time()
    rules = U.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert time.time() - start < 60
    sets = [(set(U_tokens), bad) for U_tokens, bad in spark.createDataFrame(rows, "url string, bad boolean").select(U.url_tokens(F.col("url")), "bad").collect()]
    for r in rules:
        n = [b for s, b in sets if set(r.tokens) <= s]
        assert abs(r.confidence - sum(n) / len(n)) < 1e-12 and len(r.tokens) <= 3
    singles = {tuple(r.tokens) for r in rules if len(r.tokens) == 1}
    assert ("path:saa",) in singles and ("path:taa",) in singles and ("site:a.b",) in singles
