"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent letter n-grams (one to three letters, word
boundaries included) by rank. A text is compared to each language's profile by
out-of-place distance: the sum over the text's own top n-grams of the difference in
rank, with a fixed penalty for an n-gram that the profile lacks.

Language profiles are learned from about ``PER_LANGUAGE`` documents of each language
value, all if there are fewer: a share of them, drawn by the MD5 of the id. Their
n-grams are counted in Spark. A prediction always reads the whole text.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, packed, unpacked

UNKNOWN = "und"
#: N-grams of a profile; also the penalty for a missing one.
PROFILE = 400
#: Documents from which a language's profile is learned, about, at most.
PER_LANGUAGE = 1000
#: Stands for the edge of a word. Not a letter.
EDGE = 1
#: Every how many-th remainder of the id's checksum is held out of learning.
FOLDS, HELD_OUT = 4, 2


def letter_table() -> np.ndarray:
    """Packed bits: which code points are letters."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def ngrams(text: str | None, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes (ascending) and their counts; empty without a letter.

    A code packs up to three code points of 21 bits. Letters are lower-cased; every
    run of other characters is one word edge.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text:
        return none
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    c = np.full(len(cp) + 2, EDGE, np.int64)
    c[1:-1] = np.where(letters[cp], cp, EDGE)
    inner = c != EDGE
    if not inner.any():
        return none
    keep = inner.copy()
    keep[1:] |= inner[:-1]
    keep[0] = True
    c = c[keep]
    if c[1] == EDGE:  # the text begins with other characters
        c = c[1:]
    pairs = c[:-1] << 21 | c[1:]
    triples = (pairs[:-1] << 21 | c[2:])[c[1:-1] != EDGE]
    return np.unique(np.concatenate([c[c != EDGE], pairs, triples]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Language profiles as one matrix of ranks over the union of their n-grams."""

    def __init__(self, by_lang: dict[str, np.ndarray], size: int = PROFILE):
        self.langs, self.size = sorted(by_lang), size
        self.union = np.unique(np.concatenate([by_lang[k] for k in self.langs])) if by_lang else np.zeros(0, np.int64)
        self.rank = np.full((len(self.langs), len(self.union)), -1, np.int64)
        for row, k in enumerate(self.langs):
            self.rank[row, np.searchsorted(self.union, by_lang[k])] = np.arange(len(by_lang[k]))

    def predict(self, own: np.ndarray) -> tuple[str, float]:
        """The nearest language of a ranked text profile, ties by name, and 1 - distance / worst distance."""
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.union, own)
        known = at < len(self.union)
        known[known] = self.union[at[known]] == own[known]
        place = self.rank[:, at[known]]
        off = np.where(place < 0, self.size, np.minimum(np.abs(place - np.nonzero(known)[0]), self.size))
        far = off.sum(axis=1) + (len(own) - known.sum()) * self.size
        best = int(far.argmin())
        return self.langs[best], float(1 - far[best] / (len(own) * self.size))


def fold(id_col: Column, folds: int = FOLDS) -> Column:
    """Checksum of the id as text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def learn_profiles(labelled: DataFrame, per_language: int = PER_LANGUAGE, size: int = PROFILE) -> Profiles:
    """Profiles from ``labelled`` (id, text, lang); rows with a null text or lang don't count.

    The sample is drawn by a hash of id and text, so null and repeated ids don't matter;
    the row with the lowest draw is always in, so every language value has a profile.
    """
    rows = labelled.filter("text is not null and lang is not null")
    # A number below 1 from id and text; rows alike in both are drawn alike.
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text")), 11) / F.lit(float(2 ** 53))
    rows = rows.withColumn("draw", draw)
    share = materialise(rows.groupBy("lang").agg((F.lit(per_language) / F.count("*")).alias("share"), F.min("draw").alias("least")),
                        "language-shares")
    sample = rows.join(share, "lang").filter("draw < share or draw = least").select("lang", "text")
    letters = letter_table()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.unpackbits(letters).astype(bool)
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                each = [ngrams(t, table) for t in texts]
                codes = np.concatenate([e[0] for e in each])
                code, at = np.unique(codes, return_inverse=True)
                n = np.bincount(at, np.concatenate([e[1] for e in each]), len(code)).astype(np.int64)
                yield pd.DataFrame({"lang": lang, "code": code, "n": n})

    counts = sample.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "code"))
    top = counts.withColumn("place", place).filter(F.col("place") <= size).select("lang", "code", "place").toPandas()
    return Profiles({k: g.sort_values("place")["code"].to_numpy(np.int64) for k, g in top.groupby("lang")}, size)


def predict_column(text: Column, profiles: Profiles) -> Column:
    """Struct (lang string, score double) of a text."""
    letters = letter_table()

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = np.unpackbits(letters).astype(bool)
        for s in batches:
            out = [profiles.predict(ranked(*ngrams(t, table), profiles.size)) for t in s]
            yield pd.DataFrame({"lang": [o[0] for o in out], "score": [o[1] for o in out]},
                               columns=["lang", "score"]).astype({"lang": object, "score": float})
    return run(text)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       per_language: int = PER_LANGUAGE, size: int = PROFILE) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``lang_pred`` and ``score``.

    Profiles are learned from rows that are not held out and have a language; the
    language, source and id of a row have no part in its prediction. A null text, or
    one without a letter, is ``und`` with score 0, and so is every text if nothing
    could be learned; ties between languages go to the first by name; repeated rows
    are predicted alike; columns called like an output are replaced.
    """
    held = fold(F.col(id_col)) == HELD_OUT
    labelled = docs.filter(~held).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                         F.col(lang_col).cast("string").alias("lang"))
    profiles = learn_profiles(labelled, per_language, size)
    predicted = packed(docs, held.alias("__held"), predict_column(F.col(text_col), profiles).alias("__pred"))
    return unpacked(predicted, docs, held_out=F.col("__held"), lang_pred=F.col("__pred.lang"), score=F.col("__pred.score"))


def reject_unidentified(docs: DataFrame, min_score: float = 0.0, id_col: str = "doc_id", text_col: str = "text",
                        lang_col: str = "lang", **kw) -> DataFrame:
    """The rows of ``docs`` in an identified language with at least ``min_score``, columns as before."""
    found = identify_languages(packed(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                      F.col(lang_col).alias("lang")), "id", "text", "lang", **kw)
    return unpacked(found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)), docs)
