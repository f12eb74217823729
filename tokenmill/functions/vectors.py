"""Column expressions on ``array<double>`` vectors (higher-order functions,
evaluated inside the JVM; weights are small literal arrays)."""
from __future__ import annotations

import math
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the reproduced numeric kernels.
LAYER_NORM_EPS = 1e-5
GELU_CUBIC = 0.044715
GELU_SCALE = math.sqrt(2.0 / math.pi)
# ---------------------------------------------------------------------------


def as_double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def vadd(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def rule_matrix(n_rows: int, n_cols: int, seed: float, scale: float) -> list[list[float]]:
    """Deterministic weights ``scale * sin(seed + 0.37 r + 0.11 c)`` (parameters
    of the registered vector queries; the SQL oracle builds the same)."""
    return [[scale * math.sin(seed + 0.37 * r + 0.11 * c) for c in range(n_cols)] for r in range(n_rows)]
