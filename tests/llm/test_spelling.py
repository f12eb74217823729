"""Spelling variants against comparing all words; the acceptor; windows of every size; odd rows."""
import random
import re
import zlib
from collections import Counter

import pytest

from tokenmill.llm import spelling as S
from tokenmill.llm.queries import op11_spelling_variants

SF = "/root/testdata/sf0.001"


def near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def deletions(words):
    """All near pairs, by words that share what is left without one code point."""
    by, out = {}, set()
    for w in words:
        for i in range(len(w)):
            by.setdefault((i, w[:i], w[i + 1:]), []).append(w)
            if w[:i] + w[i + 1:] in words:
                out.add(tuple(sorted((w, w[:i] + w[i + 1:]))))
    for ws in by.values():
        out.update((a, b) for a in ws for b in ws if a < b)
    return out


def plain(counts):
    around = {w: set() for w in counts}
    for a, b in deletions(counts):
        around[a].add(b)
        around[b].add(a)
    form = {w: min(s, key=lambda x: (-counts[x], x)) if s else None for w, s in around.items()}
    form = {w: f if f is not None and counts[f] >= 2 * counts[w] else None for w, f in form.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(around[w]), counts[form[w]] if form[w] else None) for w, n in counts.items())


def some_words(n=400, seed=2):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(n)}
    return sorted(words | {"a" * k for k in range(1, 12)} | {"ab" * k for k in range(1, 7)})


def test_plain_pairs_are_near():
    words = some_words(60)
    assert deletions(set(words)) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    words = some_words()
    a = S.Acceptor(words)

    def language(q):
        return frozenset(([""] if a.final[q] else []) + [c + r for c, to in a.arcs[q].items() for r in language(to)])
    every = [language(q) for q in range(len(a.arcs))]
    assert every[a.start] == set(words) and len(set(every)) == len(every)


@pytest.mark.parametrize("most_words,most_chars", [(S.MOST_WORDS, S.MOST_CHARS), (3, 64), (8192, 2), (0, 0)])
def test_pairs_against_all_words(spark, most_words, most_chars):
    words = some_words()
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, count long")
    got = S.near_pairs(df, most_words, most_chars).collect()
    assert all((words[r.u_count], words[r.v_count]) == (r.u, r.v) for r in got)
    assert sorted(tuple(sorted((r.u, r.v))) for r in got) == sorted(deletions(set(words)))


def test_partitions_stay_small(spark):
    words = some_words()
    df = spark.createDataFrame([(w, 1) for w in words], "word string, count long")
    sizes = S.partitions(df, 6).groupBy(*S._KEY).count().collect()
    assert all(r["count"] <= 6 or r["hi"] - r["lo"] == 1 for r in sizes) and max(r["hi"] - r["lo"] for r in sizes) > 1


def test_variants_against_all_words(spark):
    rng = random.Random(4)
    counts = {w: rng.choice([1, 2, 3, 4, 6, 8, 13, 30, 70]) for w in some_words(300, 9)}
    counts |= {"x" * 3000 + "y": 4, "x" * 3000 + "yz": 9, "x" * 1500 + "q" + "x" * 1500 + "y": 20}  # a chain of long words
    counts |= {"chain" + "s" * k: 3 * 2 ** k for k in range(9)}
    rows = [(w, i) for w, n in counts.items() for i in range(n)] + [(None, 0), ("", 0)]
    df = spark.createDataFrame(rows, "word string, count int").repartition(5)
    got = S.group_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert sorted(map(tuple, got.collect())) == plain(kept)
    assert S.group_variants(df.filter("count < 0")).collect() == []


def test_query(spark):
    counts = Counter()
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d.doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    want = plain({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    assert sorted(map(tuple, op11_spelling_variants(spark, SF).collect())) == want
