"""Operators on tables of vectors (the reference's numeric kernels as data jobs).

Rows are vectors; weights are small, parameter-sized arrays. Dense algebra
(projections, the feed-forward scorer, causal-pool tiles) runs as numpy on
Arrow batches (``mapInPandas``); everything else is built-in expressions,
joins and aggregates.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from ..functions import vectors as V
from ..plans.strategy import ship
from ..session import Written
from ..validation import TokenmillError, require, require_columns
from .tokenizer import list_sizes, map_slices


# --- V1: strict batched matrix product over cell tables ------------------------

def _same_batches(a: DataFrame, b: DataFrame, who: str) -> None:
    require_columns(a, ["batch", "i", "k", "v"], who)
    require_columns(b, ["batch", "k", "j", "v"], who)
    ba, bb = a.select("batch").distinct(), b.select("batch").distinct()
    if not ba.join(bb, "batch", "left_anti").isEmpty() or not bb.join(ba, "batch", "left_anti").isEmpty():
        raise TokenmillError("both sides must hold the same batches")


def matmul_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """``C[batch,i,j] = sum_k A[batch,i,k] * B[batch,k,j]``.

    ``a`` is ``(batch, i, k, v)``, ``b`` is ``(batch, k, j, v)``. Batches must
    match exactly on both sides (no broadcasting over batch), otherwise an
    error is raised. Join on ``(batch, k)``, then a partial+final sum.
    """
    _same_batches(a, b, "matmul_cells")
    j = a.select("batch", "i", "k", F.col("v").alias("av")).join(
        b.select("batch", "k", "j", F.col("v").alias("bv")), ["batch", "k"])
    return j.groupBy("batch", "i", "j").agg(F.sum(F.col("av") * F.col("bv")).alias("v"))


# Rows and columns of a matrix block, about.
MATRIX_TILE = 256
# Cells of left blocks that a task multiplies together.
PRODUCT_CELLS = 1 << 16


def matrix_blocks(cells: DataFrame, row: str, col: str, n_rows: int, n_cols: int, copies: int) -> DataFrame:
    """``cells`` (batch, row, col, v) packed into one row a block ``(batch, rb, cb, cells)``, once for each
    ``copy`` that the other side's blocks need. Cells without a value or inner index have no part."""
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).alias
    packed = cells.filter(F.col("v").isNotNull() & F.col("k").isNotNull()).groupBy("batch", block(row, n_rows)("rb"), block(col, n_cols)("cb")).agg(
        F.collect_list(F.struct(F.col(row).alias("r"), F.col(col).alias("c"), F.col("v").cast("double").alias("v"))).alias("cells"))
    return packed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def matmul_blocks(a: DataFrame, b: DataFrame, tile: int = MATRIX_TILE) -> DataFrame:
    """:func:`matmul_cells` for large dense matrices, as double products of blocks.

    Rows, inner index and columns are dealt to blocks of about ``tile`` by hash, so that
    neither skew nor sparse keys matter. The replication is three-dimensional: a block of
    ``a`` goes to every block column of ``b``, a block of ``b`` to every block row of ``a``,
    and each (row, inner, column) triple of blocks is one dense product in numpy. Block rows
    are shuffled, not one row per product; the partial cells of the inner blocks are summed.
    """
    require(tile >= 1, "tile must be >= 1")
    _same_batches(a, b, "matmul_blocks")

    def count(df: DataFrame, col: str) -> int:
        return max(1, -(-(df.select("batch", col).distinct().groupBy("batch").count().agg(F.max("count")).first()[0] or 1) // tile))

    ni, nk, nj = count(a, "i"), max(count(a, "k"), count(b, "k")), count(b, "j")
    left = matrix_blocks(a, "i", "k", ni, nk, nj).select("batch", F.col("rb").alias("bi"), F.col("cb").alias("bk"), F.col("copy").cast("long").alias("bj"), F.col("cells").alias("left"))
    right = matrix_blocks(b, "k", "j", nk, nj, ni).select("batch", F.col("copy").cast("long").alias("bi"), F.col("rb").alias("bk"), F.col("cb").alias("bj"), F.col("cells").alias("right"))
    pairs = left.join(right, ["batch", "bi", "bk", "bj"]).select("batch", "left", "right")
    types = {f.name: f.dataType for f in (*a.schema.fields, *b.schema.fields)}
    schema = StructType([StructField("batch", types["batch"]), StructField("i", types["i"]), StructField("j", types["j"]), StructField("v", DoubleType())])

    def make():
        return lambda batch: _products(batch, [f.type for f in to_arrow_schema(schema)])
    sized = pairs.select("batch", "right", "left")
    return map_slices(sized, "left", schema, make, PRODUCT_CELLS).groupBy("batch", "i", "j").agg(F.sum("v").alias("v"))


def _numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the values of an array, NULL being a value, and the distinct values."""
    encoded = values.dictionary_encode(null_encoding="encode")
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def _products(batch: pa.RecordBatch, types: list[pa.DataType]) -> list[pa.Array]:
    """The products of the blocks ``(batch, right, left)`` as cells; blocks stay Arrow arrays."""
    out: list[list] = [[], [], [], []]
    for at in range(batch.num_rows):
        y, x = (batch.column(c).slice(at, 1).flatten() for c in (1, 2))
        (rows, inner, xv), (inner2, cols, yv) = ([pc.struct_field(cells, f) for f in ("r", "c", "v")] for cells in (x, y))
        (ri, r_names), (ci, c_names) = _numbered(rows), _numbered(cols)
        both, inner_names = _numbered(pa.concat_arrays([inner, inner2.cast(inner.type)]))
        k = len(inner_names)
        m, n = np.zeros((len(r_names), k)), np.zeros((k, len(c_names)))
        np.add.at(m, (ri, both[:len(inner)]), xv.to_numpy(zero_copy_only=False))
        np.add.at(n, (both[len(inner):], ci), yv.to_numpy(zero_copy_only=False))
        # Cells that share no inner index are not part of the result.
        met = _held(m.shape, ri, both[:len(inner)]).astype(float) @ _held(n.shape, both[len(inner):], ci).astype(float) > 0
        i, j = np.nonzero(met)
        key = batch.column(0).take(pa.array(np.full(len(i), at)))
        for held, new in zip(out, (key, r_names.take(pa.array(i)), c_names.take(pa.array(j)), pa.array((m @ n)[i, j]))):
            held.append(new)
    return [pa.concat_arrays([c.cast(t) for c in col]) if col else pa.array([], t) for col, t in zip(out, types)]


def _held(shape: tuple[int, int], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    out = np.zeros(shape, bool)
    out[rows, cols] = True
    return out


# --- V2, V3, V6: per-vector kernels --------------------------------------------

def _dim_split(df: DataFrame, col: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose vector has ``dim`` entries, the others with a ``reason``); a NULL
    vector, or one with a NULL entry, is among the others."""
    fits = F.coalesce((F.size(col) == dim) & F.forall(col, lambda x: x.isNotNull()), F.lit(False))
    why = F.when(F.col(col).isNull(), "the vector is NULL").when(
        F.size(col) != dim, F.format_string(f"%d entries instead of {dim}", F.size(col))).otherwise("an entry is NULL")
    return df.filter(fits), df.filter(~fits).withColumn("reason", why)


def standardize_vectors(df: DataFrame, col: str, dim: int, scale: Sequence[float] | None = None,
                        shift: Sequence[float] | None = None, unbiased: bool = False,
                        out: str = "out") -> tuple[DataFrame, DataFrame]:
    """V2 (layer norm): ``(x - mean) / sqrt(var + eps) * scale + shift`` per
    vector, population variance unless ``unbiased``. Returns
    ``(result, rejects)``; rows whose vector does not have ``dim`` entries
    are rejected."""
    ok, bad = _dim_split(df, col, dim)
    g = np.ones(dim) if scale is None else np.asarray(scale, dtype=np.float64)
    b = np.zeros(dim) if shift is None else np.asarray(shift, dtype=np.float64)

    def norm(x: np.ndarray) -> np.ndarray:
        # Higher-order functions would evaluate mean and deviation once per entry.
        return (x - x.mean(axis=1, keepdims=True)) / np.sqrt(
            x.var(axis=1, ddof=int(unbiased), keepdims=True) + V.LAYER_NORM_EPS) * g + b
    return _dense_map(ok, col, out, norm), bad


def _dense_map(df: DataFrame, col: str, out: str, fn) -> DataFrame:
    """Apply a numpy function ``(n, d) -> (n, d')`` to a vector column, one
    Arrow batch at a time (the dense-algebra kernels of V3/V6)."""
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType()))])

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[col]])
            y = fn(x)
            pdf = pdf.copy()
            pdf[out] = list(y)
            yield pdf
    return df.mapInPandas(run, schema)


def project_vectors(df: DataFrame, col: str, weight_t: Sequence[Sequence[float]],
                    bias: Sequence[float] | None = None, out: str = "out") -> tuple[DataFrame, DataFrame]:
    """V6: linear projection ``x W (+ b)``; ``weight_t[j]`` is column j of W. Returns
    ``(result, rejects)`` like V2."""
    w = np.asarray(weight_t, dtype=np.float64).T
    b = None if bias is None else np.asarray(bias, dtype=np.float64)
    require(all(len(r) == w.shape[0] for r in weight_t), "ragged weight matrix")
    ok, bad = _dim_split(df, col, w.shape[0])
    return _dense_map(ok, col, out, lambda x: x @ w + (0.0 if b is None else b)), bad


def gelu_np(x: np.ndarray) -> np.ndarray:
    return 0.5 * x * (1.0 + np.tanh(V.GELU_SCALE * (x + V.GELU_CUBIC * x ** 3)))


def score_ffn(df: DataFrame, col: str, w1_t, b1, w2_t, b2, out: str = "out") -> tuple[DataFrame, DataFrame]:
    """V3: ``Linear -> tanh-GELU -> Linear`` per vector; wrong sizes rejected."""
    w1 = np.asarray(w1_t, dtype=np.float64).T
    w2 = np.asarray(w2_t, dtype=np.float64).T
    c1, c2 = np.asarray(b1, dtype=np.float64), np.asarray(b2, dtype=np.float64)
    ok, bad = _dim_split(df, col, w1.shape[0])
    return _dense_map(ok, col, out, lambda x: gelu_np(x @ w1 + c1) @ w2 + c2), bad


# --- V4: token + position embedding ---------------------------------------------

# A token table up to this size goes to every task; so do the positions of a window.
BROADCAST_BYTES = 32 << 20
# Tokens beyond one in this many of all tokens are hot; there are fewer of them than that.
HOT_SHARE = 256


def frequent_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> list:
    """Values of ``key`` in more than one in ``share`` of the rows: fewer than ``share`` values. Counts
    are merged from the partial counts of the tasks, one row a value."""
    counts = rows.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    seen = Written(counts, "key-counts")
    n = seen.df.agg(F.sum("n")).first()[0] or 0
    hot = [r["key"] for r in seen.df.filter((F.col("n") * share > n) & F.col("key").isNotNull()).collect()]
    seen.drop()
    return hot


def join_skewed(rows: DataFrame, table: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` left-joined with ``table`` (distinct ``key``), which is too large for every task.

    The hot keys' rows stay where they are and get their fewer than ``share`` table rows by
    broadcast; only the rows of other keys are shuffled, so no task gathers a hot key.
    """
    hot = frequent_keys(rows, key, share)
    if not hot:
        return rows.join(table, key, "left")
    is_hot = F.col(key).isin(hot)
    cold = rows.filter(~F.coalesce(is_hot, F.lit(False))).join(table, key, "left")
    return rows.filter(is_hot).join(F.broadcast(table.filter(is_hot)), key, "left").unionByName(cold)


def _table_bytes(table: DataFrame, vec: str, item: int = 8) -> int:
    n, size = table.agg(F.count("*"), F.max(F.size(vec))).first()
    return n * item * max(size or 0, 1)


def embed_tokens(windows: DataFrame, token_emb: DataFrame, pos_emb: DataFrame,
                 ids_col: str = "input_ids", measure: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Per window position: ``token_emb[token] + pos_emb[pos]``.

    Returns ``(keys…, pos, token, emb array<double>)``. Embedding tables are
    ``(token, vec)`` / ``(pos, vec)`` with distinct keys. An unknown token yields NULL; another's
    position past the position table is an error. Of tables beyond ``BROADCAST_BYTES`` only the tokens
    and positions that the windows hold count; ``windows`` are then written, and read more than
    once. A token table that is still beyond it is joined by :func:`join_skewed`. Positions are
    joined last, by broadcast if they are few, so vectors are not shuffled.

    With ``measure``, a function from vectors ``(n, d)`` to a number each, the embeddings are made
    and measured where the windows are, by arrays, and none leaves the task. Returns
    ``(keys…, total double, unknown long)``: the sum of the measures of the embeddings that
    are not NULL and have no NULL entry (NULL if there are none), and how many are NULL. A window with positions
    has one such row, or several that add up.
    """
    keys = [c for c in windows.columns if c not in (ids_col, "target_ids")]
    te = token_emb.select("token", V.as_double(F.col("vec")).alias("te"))
    pe = pos_emb.select(F.col("pos").cast("int").alias("pos"), V.as_double(F.col("vec")).alias("pe"))
    # Vectors that are measured are shipped as they are, others as doubles.
    t_item, p_item = (4 if measure and isinstance(t.schema["vec"].dataType.elementType, FloatType) else 8 for t in (token_emb, pos_emb))
    small = _table_bytes(token_emb, "vec", t_item) <= BROADCAST_BYTES
    few = _table_bytes(pos_emb, "vec", p_item) <= BROADCAST_BYTES
    ids = windows.select(*keys, ids_col)
    if not (small and few):
        ids = Written(ids, "windows").df
    if not few:  # positions past the longest window are not asked for
        longest = ids.agg(F.max(F.size(ids_col))).first()[0] or 0
        pe = pe.filter(F.col("pos") < longest)
        few = _table_bytes(pe, "pe", p_item) <= BROADCAST_BYTES
    if not small:  # nor are vectors of tokens that no window holds
        te = Written(te.join(_held_tokens(ids.select(ids_col)), "token", "left_semi"), "used-vectors").df
        small = _table_bytes(te, "te", t_item) <= BROADCAST_BYTES
    if measure is not None and small and few:
        return _measured_windows(ids, ids_col, (te, t_item), (pe, p_item), measure)
    ex = ids.select(*keys, F.posexplode(ids_col).alias("pos", "token"))
    j = ex.join(F.broadcast(te), "token", "left") if small else join_skewed(ex, te, "token")
    j = j.join(F.broadcast(pe) if few else pe, "pos", "left")
    # Checked in the same job: a position past the table fails the query.
    pe_checked = F.when(F.col("pe").isNull(), F.raise_error(
        F.format_string("position %d exceeds the position table", F.col("pos")))
    ).otherwise(F.col("pe"))
    out = j.select(*keys, "pos", "token", V.vadd(F.col("te"), pe_checked).alias("emb"))
    return out if measure is None else _measured_rows(out.select(*keys, "emb"), measure)


def _held_tokens(ids: DataFrame) -> DataFrame:
    """``(token)``: the distinct tokens of lists, a row a token and slice before they are shuffled."""
    token = StructField("token", ids.schema.fields[0].dataType.elementType)

    def make():
        return lambda batch: [pc.unique(batch.column(0).flatten())]
    return map_slices(ids, ids.columns[0], StructType([token]), make).distinct()


# Vector entries that are added and measured together; they stay in a core's cache.
MEASURE_CELLS = 1 << 17
MEASURED = [StructField("total", DoubleType()), StructField("unknown", LongType())]
#: A token beyond this many times the tokens of the table is looked up by search, not in a dense table.
SPARSE_TOKENS = 64


@dataclass
class VectorTable:
    """Vectors by key; the rows of a key lie one behind the other, in ``begin … begin + count - 1`` of its place in ``keys``."""
    keys: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    values: np.ndarray  # (rows + 1, width), zero where a vector has no entry; the last row stands for no vector
    sizes: np.ndarray   # entries of each vector, -1 for NULL and for the last row
    whole: np.ndarray   # no entry is NULL

    @classmethod
    def collect(cls, table: DataFrame, item: int, key: str, vec: str, width: int) -> VectorTable:
        rows = table.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), vec).toArrow().combine_chunks()
        rows = rows.sort_by(key)
        vecs = rows.column(vec).combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(vecs), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vecs.flatten()
        row = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
        ends = np.cumsum(np.maximum(sizes, 0))
        at = np.arange(len(flat)) - np.repeat(ends - np.maximum(sizes, 0), np.maximum(sizes, 0))
        values, whole = np.zeros((len(sizes) + 1, width), f"f{item}"), np.ones(len(sizes) + 1, bool)
        values[row, at] = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
        whole[row[flat.is_null().to_numpy(zero_copy_only=False)]] = False
        keys, begin, count = np.unique(rows.column(key).to_numpy(), return_index=True, return_counts=True)
        return cls(keys, begin, count, values, np.concatenate([sizes, [-1]]), whole)

    def finder(self) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """A function of keys: the first row and the number of rows of each; the last row, once, for an unknown key."""
        begin, count = np.append(self.begin, len(self.values) - 1), np.append(self.count, 1)
        keys, none = self.keys, len(self.keys)
        if none and keys[0] >= 0 and keys[-1] < SPARSE_TOKENS * max(none, 1 << 10):
            dense = np.full(int(keys[-1]) + 2, none)
            dense[keys] = np.arange(none)
            place = lambda x: dense[np.where((x < 0) | (x > keys[-1]), len(dense) - 1, x)]
        else:
            def place(x: np.ndarray) -> np.ndarray:
                at = np.minimum(np.searchsorted(keys, x), max(0, none - 1))
                return np.where(keys[at] == x, at, none) if none else np.zeros(len(x), np.int64)

        def find(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = place(x)
            return begin[at], count[at]
        return find


def _totals(row: np.ndarray, n_rows: int, measured: np.ndarray, counts: np.ndarray, unknown: np.ndarray) -> list[pa.Array]:
    """``total`` and ``unknown`` of each of ``n_rows`` windows from those of the positions; ``row`` is a position's window."""
    total = np.bincount(row, np.where(counts, measured, 0.0), n_rows)
    some = np.bincount(row[counts], minlength=n_rows) > 0
    return [pa.array(total, pa.float64(), mask=~some), pa.array(np.bincount(row[unknown], minlength=n_rows), pa.int64())]


def _measured_windows(ids: DataFrame, ids_col: str, te: tuple[DataFrame, int], pe: tuple[DataFrame, int],
                      measure: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The windows' keys with ``total`` and ``unknown``, the embeddings made slice by slice from tables that every task has;
    a table comes with the bytes of an entry."""
    width = max(max(t.agg(F.max(F.size(c))).first()[0] or 0, 0) for (t, _), c in ((te, "te"), (pe, "pe")))
    tables = VectorTable.collect(*te, "token", "te", width), VectorTable.collect(*pe, "pos", "pe", width)
    shared = ship(ids.sparkSession, [tuple(vars(t).values()) for t in tables], sum(t.values.nbytes for t in tables), "the embedding tables")
    keys = [f for f in ids.schema.fields if f.name != ids_col]

    def make():
        tokens, places = (VectorTable(*t) for t in shared.value)
        token_rows, place_rows = tokens.finder(), places.finder()
        step = max(1, MEASURE_CELLS // max(1, width))
        once = bool((tokens.count == 1).all() and (places.count == 1).all())
        add = np.empty((step, width), places.values.dtype)

        def total(batch: pa.RecordBatch) -> list[pa.Array]:
            lists = batch.column(batch.num_columns - 1)
            sizes, flat = list_sizes(lists), lists.flatten()
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            codes = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            (t, nt), (p, n_p) = token_rows(codes), place_rows(pos)
            if not known.all():
                t[~known], nt[~known] = len(tokens.values) - 1, 1
            if not once:  # every row of the token with every row of the position
                n = nt * n_p
                nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                row, pos, t, p, n_p = (np.repeat(x, n) for x in (row, pos, t, p, n_p))
                t, p = t + nth // n_p, p + nth % n_p
            unknown = tokens.sizes[t] < 0
            past = (places.sizes[p] < 0) & ~unknown
            if past.any():
                raise ValueError(f"position {pos[past].min()} exceeds the position table")
            measured = np.empty(len(t))
            for lo in range(0, len(t), step):
                hi = min(lo + step, len(t))
                emb = np.take(tokens.values, t[lo:hi], axis=0).astype(float, copy=False)
                emb += np.take(places.values, p[lo:hi], axis=0, out=add[:hi - lo])
                measured[lo:hi] = measure(emb)
            whole = tokens.whole[t] & places.whole[p] & (tokens.sizes[t] == places.sizes[p])
            held = np.flatnonzero(sizes)
            out = _totals(row, len(sizes), measured, whole & ~unknown, unknown)
            return [c.take(pa.array(held)) for c in [*batch.columns[:-1], *out]]
        return total
    return map_slices(ids.select(*[f.name for f in keys], ids_col), ids_col, StructType([*keys, *MEASURED]), make)


def _measured_rows(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``rows`` (keys…, emb) with ``total`` and ``unknown`` of each row's own embedding."""
    keys = rows.schema.fields[:-1]

    def make():
        def total(batch: pa.RecordBatch) -> list[pa.Array]:
            embs = batch.column(batch.num_columns - 1)
            sizes, flat = list_sizes(embs), embs.flatten()
            row, width = np.repeat(np.arange(len(sizes)), sizes), int(sizes.max(initial=0))
            values, whole = np.zeros((len(sizes), width)), np.ones(len(sizes), bool)
            values[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
            whole[row[flat.is_null().to_numpy(zero_copy_only=False)]] = False
            unknown = embs.is_null().to_numpy(zero_copy_only=False)
            return [*batch.columns[:-1], *_totals(np.arange(len(sizes)), len(sizes), measure(values), whole & ~unknown, unknown)]
        return total
    return map_slices(rows, "emb", StructType([*keys, *MEASURED]), make)


def sum_of_squares(vectors: np.ndarray) -> np.ndarray:
    """A ``measure`` of :func:`embed_tokens`."""
    return np.einsum("ij,ij->i", vectors, vectors)


# --- V7: softmax inside groups ---------------------------------------------------

def group_softmax(df: DataFrame, group: str, score: str, out: str = "p") -> DataFrame:
    """``exp(s - max) / sum(exp(s - max))`` within each group; NULL is a group of its own,
    and a NULL score has a NULL share.

    Two partial aggregations (max, then sum) joined back, instead of a
    window: a hot group is reduced map-side rather than sorted in one task, and
    as a skewed join side it can be split.
    """
    m = df.groupBy(F.col(group).alias("_g")).agg(F.max(score).alias("_m"))
    e = df.join(m, F.col(group).eqNullSafe(F.col("_g"))).drop("_g").withColumn("_e", F.exp(F.col(score) - F.col("_m")))
    z = e.groupBy(F.col(group).alias("_g")).agg(F.sum("_e").alias("_z"))
    return e.join(z, F.col(group).eqNullSafe(F.col("_g"))).withColumn(out, F.col("_e") / F.col("_z")).drop("_g", "_m", "_e", "_z")


# --- V5: causal softmax-weighted pooling ------------------------------------------

_PARTIAL_SCHEMA = "seq long, pos long, m array<double>, l array<double>, o array<double>"
# Tiles of a key block, and of a group of queries that meet it in one task.
KEY_TILES, QUERY_TILES = 16, 64


def _rows_of(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _attend(n_heads: int, tile: int, history: int | None):
    """A group of query rows against a block of key rows: the partials ``(m, l, o)`` of the
    query rows, a tile of them at a time."""
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            krank, k, v = block["rank"].to_numpy(np.int64), _rows_of(block["k"]), _rows_of(block["v"])
            heads = list(zip(np.split(k, n_heads, 1), np.split(v, n_heads, 1)))
            queries = queries.sort_values("rank")
            for at in range(0, len(queries), tile):
                part = queries.iloc[at:at + tile]
                qrank, q = part["rank"].to_numpy(np.int64), _rows_of(part["q"])
                hidden = krank[None, :] > qrank[:, None]
                if history is not None:
                    hidden |= krank[None, :] <= qrank[:, None] - history
                rows = np.nonzero(~hidden.all(axis=1))[0]
                ms, ls, os = [], [], []
                for qh, (kh, vh) in zip(np.split(q[rows], n_heads, 1), heads):
                    s = np.where(hidden[rows], -np.inf, qh @ kh.T / math.sqrt(qh.shape[1]))
                    ms.append(s.max(axis=1))
                    p = np.exp(s - ms[-1][:, None])
                    ls.append(p.sum(axis=1))
                    os.append(p @ vh)
                seq, pos = int(part["seq"].iloc[0]), part["pos"].to_numpy(np.int64)[rows].tolist()
                for t, place in enumerate(pos):
                    out.append((seq, place, [float(x[t]) for x in ms], [float(x[t]) for x in ls],
                                np.concatenate([x[t] for x in os]).tolist()))
        return pd.DataFrame(out, columns=["seq", "pos", "m", "l", "o"])
    return run


def query_blocks(rows: DataFrame, tile: int, max_history: int | None) -> DataFrame:
    """``rows`` (rank, …) once for each key ``block`` that holds some of their history, with the
    group of queries ``grp`` they belong to. In a band these are as many for every row,
    however long the sequence; without one, all blocks up to the row's own."""
    size = F.lit(KEY_TILES * tile).cast("long")
    first = F.lit(0).cast("long") if max_history is None else F.floor(
        F.greatest(F.col("rank") - (max_history - 1), F.lit(0)) / size).cast("long")
    return rows.withColumn("block", F.explode(F.sequence(first, F.floor(F.col("rank") / size).cast("long")))).withColumn(
        "grp", F.floor(F.col("rank") / (QUERY_TILES * tile)).cast("long"))


def sequence_ranks(rows: DataFrame, tile_rows: int = 1 << 14) -> DataFrame:
    """``rows`` (seq, pos, …) with ``rank``, the position's place in its sequence from 0.

    Positions are range-partitioned, so that a long sequence spreads over tasks; ranks
    inside a (sequence, range) are offset by the counts of the ranges before.
    """
    n = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = Written(rows.repartitionByRange(n, "seq", "pos").withColumn("part", F.spark_partition_id()), "ranked-rows").df
    counts = dealt.groupBy("seq", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("seq").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("seq").alias("b_seq"), F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("seq", "part").orderBy("pos")) - 1
    return (dealt.withColumn("inside", inside).join(base, (F.col("seq") == F.col("b_seq")) & (F.col("part") == F.col("b_part")))
            .withColumn("rank", F.col("base") + F.col("inside")).drop("part", "inside", "b_seq", "b_part", "base"))


def causal_pool(df: DataFrame, seq: str, pos: str, q: str, k: str | None = None,
                v: str | None = None, n_heads: int = 1, tile: int = 64, max_history: int | None = None) -> DataFrame:
    """V5: every row summarises its own history: per head,
    ``softmax(q.k / sqrt(d_head))`` over the rows of its sequence up to its own,
    weighting the ``v`` vectors. Exact, no cap. Rows of equal position see each
    other in one order only (the order of a repeated position is not defined).

    With ``max_history`` a row sees the last ``max_history`` rows only, its own among
    them, and the work is linear in the length of a sequence; without, quadratic.

    Rows are ranked in their sequence, so sparse positions cost nothing. A task holds a
    block of ``KEY_TILES`` key tiles and the rows of up to ``QUERY_TILES`` query tiles that
    see some of it, and gives one partial ``(m, l, o)`` per query row; a key block
    crosses to Python once for that many query tiles. The partials of a row, one per block
    of its history, are merged by a max and rescaled sums (the tiled online-softmax merge).
    A hot sequence is spread over its (query group, block) pairs.
    Returns ``(seq, pos, out array<double>)``.
    """
    k = k or q
    v = v or q
    require(tile >= 1 and n_heads >= 1, "tile and n_heads must be >= 1")
    require(max_history is None or max_history >= 1, "max_history must be >= 1")
    sizes = df.agg(F.min(F.size(q)).alias("lo"), F.max(F.size(q)).alias("hi")).first()
    if sizes["lo"] is None:
        return df.sparkSession.createDataFrame([], "seq long, pos long, out array<double>")
    require(sizes["lo"] == sizes["hi"] >= 1, "all vectors must have the same size")
    d = sizes["hi"]
    require(d % n_heads == 0, "the heads must divide the vector size evenly")
    rows = sequence_ranks(df.select(
        F.col(seq).cast("long").alias("seq"), F.col(pos).cast("long").alias("pos"), V.as_double(F.col(q)).alias("q"),
        V.as_double(F.col(k)).alias("k"), V.as_double(F.col(v)).alias("v")))
    held = Written(rows, "pool-rows")
    rows, again = held.df, held.read()
    asked = query_blocks(rows.select("seq", "pos", "rank", "q"), tile, max_history)
    # A key block goes to the groups of queries that see some of it.
    wanted = query_blocks(again.select("seq", "rank"), tile, max_history).select("seq", "block", "grp").distinct()
    keys = again.select("seq", "rank", "k", "v", F.floor(F.col("rank") / (KEY_TILES * tile)).cast("long").alias("block")).join(
        wanted, ["seq", "block"])
    on = ["seq", "block", "grp"]
    parts = asked.groupBy(*on).cogroup(keys.groupBy(*on)).applyInPandas(_attend(n_heads, tile, max_history), _PARTIAL_SCHEMA)
    # A row's partials: one per key block of its history, summed element by element.
    hd = d // n_heads
    at = F.explode(F.sequence(F.lit(0), F.lit(n_heads - 1)))
    heads = parts.select("seq", "pos", "m", "l", "o", at.alias("h")).select(
        "seq", "pos", "h", F.element_at("m", F.col("h") + 1).alias("m"), F.element_at("l", F.col("h") + 1).alias("l"),
        *[F.element_at("o", F.col("h") * hd + i + 1).alias(f"o{i}") for i in range(hd)])
    top = heads.groupBy("seq", "pos", "h").agg(F.max("m").alias("top"))
    scale = F.exp(F.col("m") - F.col("top"))
    total = heads.join(top, ["seq", "pos", "h"]).groupBy("seq", "pos", "h").agg(
        F.sum(F.col("l") * scale).alias("l"), *[F.sum(F.col(f"o{i}") * scale).alias(f"o{i}") for i in range(hd)])
    one = total.select("seq", "pos", "h", F.array(*[F.col(f"o{i}") / F.col("l") for i in range(hd)]).alias("o"))
    return one.groupBy("seq", "pos").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("h", "o"))), lambda x: x["o"])).alias("out"))
