"""Benchmark decontamination with a hash set of normalised test n-grams.

A text's words are lower-cased A-Z runs of letters, digits and non-ASCII
characters. A window is ``n`` consecutive words of a benchmark item; a shorter
item is one window of its own length. The distinct windows with their hash form
the set. Every document is scanned once: the hashes of all its windows are
probed against the set and each hit is verified on the words themselves.

The set is broadcast while its estimated size stays below ``BROADCAST_BYTES``;
beyond that the same join shuffles by hash. Only hits and one row a document
leave the scan. The text is split once, and nothing is kept per window.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise, packed, unpacked

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: The hash set is broadcast up to this many bytes (hash, words and item ids of every window).
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """The normalised words of a text; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def _window_hashes(word_hashes: Column, length: Column | int) -> Column:
    """Hashes of all windows of ``length`` words, in order of their start."""
    size = F.lit(length) if isinstance(length, int) else length
    return F.when(F.size(word_hashes) >= size, F.transform(
        F.sequence(F.lit(1), F.size(word_hashes) - size + 1),
        lambda i: F.xxhash64(F.slice(word_hashes, i, size)))).otherwise(F.array().cast("array<bigint>"))


def _word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      n: int = WINDOW) -> DataFrame:
    """``(hash, window, items)``: each distinct window once, with the items it occurs in."""
    split = (items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws"))
             .filter(F.size("ws") > 0)
             .withColumn("len", F.least(F.size("ws"), F.lit(n))))
    each = split.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1),
        lambda i: F.slice(F.col("ws"), i, F.col("len")))).alias("window"))
    return (each.groupBy("window").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64(_word_hashes(F.col("window"))).alias("hash"), "window", "items"))


def _bytes(windows: DataFrame) -> int:
    """Upper bound of the set's size in memory."""
    size = F.length(F.array_join("window", " ")) * 4 + F.size("window") * 24 + F.size("items") * 64 + 128
    return windows.agg(F.sum(size)).first()[0] or 0


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", n: int = WINDOW) -> DataFrame:
    """One row for each ``(id, digest of the text)`` of ``docs``.

    Columns: ``id``, ``digest``, ``copies`` (rows of ``docs`` with both), ``n_words``,
    ``spans`` (sorted ``(first, last)`` word positions of the occurring windows,
    from 0) and ``items`` (distinct ids of the items they belong to, sorted).
    """
    windows = materialise(benchmark_windows(items, item_col, item_text, n), "bench-windows")
    lengths = sorted(r[0] for r in windows.select(F.size("window")).distinct().collect())  # n values at most
    fits = _bytes(windows) <= BROADCAST_BYTES
    probe = windows.select(F.col("hash").alias("w_hash"), "window", F.col("items").alias("w_items"))
    probe = F.broadcast(probe) if fits else probe

    scanned = docs.select(F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("digest"),
                          words(F.col(text_col)).alias("ws"))
    hashed = scanned.withColumn("hs", _word_hashes(F.col("ws")))
    # Element 0 stands for the document itself; it has no hash and meets no window.
    head = F.array(F.lit(None).cast("bigint"))
    parts = [_window_hashes(F.col("hs"), k) for k in lengths]
    each = hashed.select("id", "digest", "ws", F.posexplode(F.concat(head, *parts)).alias("at", "hash"))
    # Where the windows of each length begin among the elements.
    first, length = F.lit(1), F.lit(0)
    n_words = F.size("ws")
    edge = F.lit(1)
    for k in lengths:
        first = F.when(F.col("at") >= edge, edge).otherwise(first)
        length = F.when(F.col("at") >= edge, F.lit(k)).otherwise(length)
        edge = edge + F.greatest(n_words - k + 1, F.lit(0))
    begin = F.col("at") - first
    if fits:
        joined = each.join(probe, F.col("hash") == F.col("w_hash"), "left").filter(
            "at = 0 or w_hash is not null")
    else:  # the document's own row needs no probe, so that null hashes are not shuffled together
        own = each.filter("at = 0").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in probe.schema])
        joined = own.unionByName(each.filter("at > 0").join(probe, F.col("hash") == F.col("w_hash")))
    found = joined.select(
        "id", "digest", "at", F.when(F.col("at") == 0, n_words).alias("n_words"),
        F.when((F.col("at") > 0) & (F.slice("ws", begin + 1, F.greatest(length, F.lit(1))) == F.col("window")),
               F.struct(begin.alias("first"), (begin + F.size("window") - 1).alias("last"))).alias("span"),
        F.when(F.col("at") > 0, F.col("w_items")).alias("w_items"))
    kept = found.filter("at = 0 or span is not null")
    return kept.groupBy("id", "digest").agg(
        F.count("n_words").alias("copies"), F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("w_items")))).alias("items"))


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("reach"))

    def step(acc, s):
        return F.struct(
            (acc["n"] + F.greatest(s["last"] - F.greatest(s["first"] - 1, acc["reach"]), F.lit(0))).alias("n"),
            F.greatest(acc["reach"], s["last"]).alias("reach"))
    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", n: int = WINDOW) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    One row for each row of ``docs``, repeated rows included. A null or wordless
    text has no words and no hits; a null or wordless item has no window; an item
    whose id is null marks hits but is not among the items; equal item ids are one
    item; with no items nothing is contaminated.
    """
    hits = find_hits(docs, items, id_col, text_col, item_col, item_text, n)
    n_hit = covered(F.col("spans"))
    each = hits.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.sequence(F.lit(1).cast("long"), "copies").alias("copy"))
    return each.withColumn("copy", F.explode("copy")).drop("copy")


def remove_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **kw) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark window occurs."""
    bad = materialise(find_hits(docs, items, id_col, text_col, **kw).filter(F.size("spans") > 0).select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest")), "bench-hits")
    # A hit has a text, hence a digest; the id may be null.
    rows = packed(docs, F.md5(F.col(text_col)).alias("__text"), F.col(id_col).alias("__key"))
    return unpacked(rows.join(bad, (F.col("__text") == F.col("__digest")) & F.col("__key").eqNullSafe(F.col("__id")),
                              "left_anti"), docs)


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **kw) -> DataFrame:
    """``docs`` with the hit words, and what stands between two hit neighbours, cut out of the text.

    Words before and after a cut keep what separated them. Rows without hits are unchanged.
    """
    spans = materialise(find_hits(docs, items, id_col, text_col, **kw).filter(F.size("spans") > 0).select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("spans").alias("__spans")), "bench-spans")
    rows = packed(docs, F.md5(F.col(text_col)).alias("__text"), F.col(id_col).alias("__key"))
    joined = rows.join(spans, (F.col("__text") == F.col("__digest")) & F.col("__key").eqNullSafe(F.col("__id")), "left")
    # Pieces: each word with the separators before it, then the tail.
    sep = r"[\x00-\x2F\x3A-\x60\x7B-\x7F&&[^A-Z]]"
    text = F.col("__row").getField(text_col)
    pieces = F.regexp_extract_all(text, F.lit(f"{sep}*(?:[A-Z]|{WORD[:-1]})+"), F.lit(0))
    tail = F.regexp_extract(text, f"(?s)({sep}*)$", 1)
    kept = F.filter(pieces, lambda _, i: ~F.exists(
        "__spans", lambda s: (s["first"] <= i) & (i <= s["last"])))
    cut = F.when(F.col("__spans").isNull(), text).otherwise(F.concat(F.array_join(kept, ""), tail))
    whole = unpacked(joined, docs, **{text_col: cut})
    return whole.select(*[F.col(f"`{c}`") for c in docs.columns])
