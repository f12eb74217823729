"""Small argument and schema checks shared by the public operators."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class TokenmillError(ValueError):
    """Raised when an operator's input violates its contract."""


def require_columns(df: DataFrame, columns: Iterable[str], where: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise TokenmillError(
            f"{where}: missing column(s) {missing}; got {df.columns}")


def require(condition: bool, message: str) -> None:
    if not condition:
        raise TokenmillError(message)
