"""Shared helpers of the corpus operators: table access, tokens, clashing columns; ``materialise``
writes a table once to the shared folder."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written as materialise

__all__ = ["TOKEN", "UPPER", "ascii_lower", "materialise", "packed", "table", "token_count", "unpacked"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A token is a run without space, tab, LF, VT, FF and CR.
TOKEN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does the same on pure ASCII and is
    much cheaper than ``translate``, so it takes the texts without other letters."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def token_count(c: Column) -> Column:
    """Number of tokens; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0)).cast("long")


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``df`` as the struct ``__row``, with further columns over ``df``: whatever
    the input's columns are called, an operator's own names cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), *more)


def unpacked(df: DataFrame, like: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``like`` out of ``__row``, then the new ones; a new column replaces an
    input column of its name."""
    keep = [c for c in like.columns if c.lower() not in {n.lower() for n in new}]
    return df.select(*[F.col("__row").getField(c).alias(c) for c in keep], *[c.alias(n) for n, c in new.items()])
