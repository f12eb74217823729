"""Decoding token arrays back to text."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import unmark
from ..validation import require_columns
from .tokenizer import decode_lists


def decode_tokens(tokens: DataFrame, vocab: DataFrame, raw: bool = False) -> DataFrame:
    """``(keys…, text)`` for ``(keys…, tokens array<int>)``, one row per input row.

    One map-only stage at every vocabulary size. The space marker becomes a
    space unless ``raw``; a NULL list gives NULL; a token missing from the
    vocabulary, or NULL, contributes nothing.
    """
    require_columns(tokens, ["tokens"], "decode_tokens")
    require_columns(vocab, ["token", "text"], "decode_tokens")
    keys = [c for c in tokens.columns if c not in ("tokens", "n_tokens")]
    out = decode_lists(tokens.select(*keys, "tokens"), "tokens", vocab)
    return out if raw else out.select(*keys, unmark(F.col("text")).alias("text"))
