"""URL filtering: explicit prefix rules first, association rules for the rest.

Explicit rules are (host, path) prefixes; the longest that fits decides. Every
other url is judged by association rules: FP-growth, bounded in length, mines the combinations of
URL tokens that labelled pages share, and a combination that is frequent enough and
mostly bad becomes a rule. A url that holds all tokens of a rule is blocked.

Rules match by an inverted index: each rule is filed under its rarest token, so
a url looks up its tokens and then checks the few rules found. The index is
bounded by the support: ``MIN_SUPPORT`` and ``MAX_LENGTH`` allow no more than
``tokens per url ** MAX_LENGTH / MIN_SUPPORT`` combinations at any corpus size.
"""
from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise, packed, unpacked

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Share of the labelled pages that a combination must reach together with the bad label.
MIN_SUPPORT = 0.002
#: Share of bad pages among those with the combination.
MIN_CONFIDENCE = 0.5
#: Tokens of a rule at most.
MAX_LENGTH = 3
#: A rule set is broadcast up to this many rules; beyond that the index is joined by shuffle.
BROADCAST_RULES = 100_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a url, each with the part it is from: the scheme, the host's
    labels and registered end, path segments, the file ending, query names and the
    presence of a fragment. Numbers count by their digits."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    tag = lambda name, c: F.transform(c, lambda x: F.concat(F.lit(name + ":"), x))
    segments = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, "[0-9]+", "9"))
    names = F.transform(F.split(query, "&"), lambda q: F.substring_index(q, "=", 1))
    every = F.concat(
        F.array(F.concat(F.lit("scheme:"), scheme), F.concat(F.lit("site:"), host)),
        tag("host", labels), tag("host", F.flatten(F.transform(labels, lambda x: F.split(x, "-")))),
        tag("path", segments), tag("query", names),
        F.array(F.when(F.instr(url, "#") > 0, F.lit("fragment:yes"))))
    clean = F.filter(every, lambda t: t.isNotNull() & ~t.rlike(r"(?s)^[a-z]+:$") & ~F.contains(t, F.lit("\u0000")))
    return F.coalesce(F.array_distinct(clean), F.array().cast("array<string>"))


def free_sets(baskets: DataFrame, least: int, max_length: int) -> DataFrame:
    """``(tokens, n, n_bad)``: combinations of up to ``max_length`` tokens with at least ``least`` bad pages.

    FP-growth on conditional bases: a base holds, for a combination, what follows its last
    token in the (sorted) baskets, equal rests as one row with their numbers of pages. Growing
    it by one token gives the bases of the next length, which ends the growth at
    ``max_length`` whatever the baskets' lengths. A combination on the same pages as one of its
    parts, and with it all that contain it, adds nothing: its part is as confident a rule and
    shorter. So copies of a long url grow to pairs and stop.
    """
    base = baskets.select(F.array().cast("array<string>").alias("tokens"), F.col("items").alias("rest"), "n", "n_bad")
    out, last = None, None
    for length in range(1, max_length + 1):
        grown = base.select("tokens", "rest", "n", "n_bad", F.posexplode("rest").alias("at", "token")).select(
            F.concat("tokens", F.array("token")).alias("tokens"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"), "n", "n_bad")
        grown = materialise(grown.groupBy("tokens", "rest").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")), f"url-base-{length}")
        sets = grown.groupBy("tokens").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).filter(F.col("n_bad") >= least)
        if last is not None:
            # All parts that lack one token must be there, with more pages.
            drop = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.filter("tokens", lambda t, j: j != i))
            parts = sets.select("tokens", "n", F.explode(drop).alias("part")).join(
                last.select(F.col("tokens").alias("part"), F.col("n").alias("part_n")), "part")
            free = parts.filter("part_n > n").groupBy("tokens").agg(F.count("*").alias("parts")).filter(F.col("parts") == length).select("tokens")
            sets = sets.join(free, "tokens", "left_semi")
        last = materialise(sets, f"url-sets-{length}")
        out = last if out is None else out.unionByName(last)
        # Go on from the free combinations, with the rests' tokens that are frequent by themselves.
        if length == 1:
            frequent = last.select(F.col("tokens")[0].alias("token"))
            kept = baskets.select("items", "n", "n_bad", F.explode("items").alias("token")).join(frequent, "token", "left_semi")
            kept = kept.groupBy("items", "n", "n_bad").agg(F.array_sort(F.collect_list("token")).alias("kept"))
            base = kept.select(F.posexplode("kept").alias("at", "token"), "kept", "n", "n_bad").select(
                F.array("token").alias("tokens"), F.slice("kept", F.col("at") + 2, F.size("kept")).alias("rest"), "n", "n_bad")
            base = base.groupBy("tokens", "rest").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))
        else:
            base = grown.join(last.select("tokens"), "tokens", "left_semi")
    return out


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               max_length: int = MAX_LENGTH) -> DataFrame:
    """``(tokens, confidence, lift, support)`` of the combinations that predict a bad page.

    ``labelled`` has ``url`` and ``bad`` (boolean; null rows are left out). Rules
    that a shorter rule with at least their confidence contains are pruned.
    """
    schema = "tokens array<string>, confidence double, lift double, support double"
    baskets = labelled.filter("url is not null and bad is not null").select(url_tokens(F.col("url")).alias("items"), "bad")
    # Equal baskets are one row with their numbers of pages and of bad pages.
    baskets = materialise(baskets.filter((F.size("items") > 0) | F.col("bad")).groupBy(F.array_sort("items").alias("items")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("n_bad")), "url-baskets")
    total, bad = baskets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_bad"), F.lit(0))).first()
    least = max(1, ceil(min_support * total))
    if bad < least:
        return labelled.sparkSession.createDataFrame([], schema)
    sets = free_sets(baskets, least, max_length)
    confidence = F.col("n_bad") / F.col("n")
    rules = sets.select(F.array_sort("tokens").alias("tokens"), confidence.alias("confidence"), (confidence / F.lit(bad / total)).alias("lift"),
                        (F.col("n_bad") / F.lit(total)).alias("support"))
    rules = materialise(rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") > 1)), "url-rules")
    a, b = rules.alias("a"), rules.select(F.col("tokens").alias("t"), F.col("confidence").alias("c"),
                                          F.explode("tokens").alias("one")).alias("b")
    # A shorter rule that this one contains shares a token with it.
    longer = a.select("tokens", "confidence", F.explode("tokens").alias("one"))
    beaten = (longer.join(b, "one").filter((F.size("t") < F.size("tokens")) & (F.col("c") >= F.col("confidence"))
                                           & (F.size(F.array_except("t", "tokens")) == 0))
              .select("tokens").distinct())
    return rules.join(beaten, "tokens", "left_anti")


def index_rules(rules: DataFrame) -> DataFrame:
    """The inverted index ``(anchor, rule_tokens, rule_confidence)``: each rule under its rarest token."""
    tokens = rules.select("tokens", "confidence", F.explode("tokens").alias("anchor"))
    freq = tokens.groupBy("anchor").agg(F.count("*").alias("n"))
    return (tokens.join(freq, "anchor").groupBy("tokens", "confidence")
            .agg(F.min(F.struct("n", "anchor"))["anchor"].alias("anchor"))
            .select("anchor", F.col("tokens").alias("rule_tokens"), F.col("confidence").alias("rule_confidence")))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, confidence)`` of the distinct urls of ``urls`` (one column) that a rule blocks."""
    index = materialise(index_rules(rules), "url-index")
    small = index.count() <= BROADCAST_RULES
    tokens = urls.select("url", url_tokens(F.col("url")).alias("tokens"))
    each = tokens.select("url", "tokens", F.explode("tokens").alias("anchor"))
    hits = each.join(F.broadcast(index) if small else index, "anchor").filter(
        F.size(F.array_except("rule_tokens", "tokens")) == 0)
    return hits.groupBy("url").agg(F.max("rule_confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labelled: DataFrame, url_col: str = "url", rules=RULES, **mining) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``confidence``.

    ``verdict`` is the explicit rule's, else ``block`` if a mined rule matches and
    ``allow`` otherwise; ``confidence`` is the best mined rule's where that decided.
    A null url, or one without ``://``, has empty host and path, fits no explicit
    rule and is allowed unless a mined rule fits its tokens. Repeated rows are
    judged alike; without labels nothing is mined; clashing columns are replaced.
    """
    mined = mine_rules(labelled, **mining)
    url = F.col(url_col)
    parts = (packed(pages, url.alias("__url"), host_of(url).alias("__host"), path_of(url).alias("__path"))
             .withColumn("__fit", explicit_rule(F.col("__host"), F.col("__path"), rules)))
    # The method only needs the urls that no explicit rule decides, each once.
    open_urls = parts.filter("__fit is null and __url is not null").select(F.col("__url").alias("url")).distinct()
    blocked = match_rules(open_urls, mined).select(F.col("url").alias("__b_url"), F.col("confidence").alias("__conf"))
    joined = parts.join(blocked, F.col("__fit").isNull() & (F.col("__url") == F.col("__b_url")), "left")
    verdict = F.coalesce(F.col("__fit")["verdict"],
                         F.when(F.col("__conf").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return unpacked(joined, pages, host=F.col("__host"), path=F.col("__path"), rule=F.col("__fit")["rule"],
                    verdict=verdict, confidence=F.col("__conf"))
