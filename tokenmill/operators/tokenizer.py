"""A vocabulary and merge table on the executors, applied to Arrow batches.

Documents stay one row each: a column of string lists is looked up by its
distinct values per batch (Arrow's dictionary encoding) and the code lists are put
together with numpy, so nothing is exploded, shuffled or joined. The tables are
bounded by the vocabulary size, a parameter, and shipped behind a size check.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..plans.strategy import collect_checked, ship, text_bytes
from ..validation import require, require_columns
from .pieces import split_segments, text_buffers

# List entries, or bytes of text, of a batch that are worked on together (a row is not cut).
SLICE_ITEMS = 1 << 19
# Bytes of text whose pieces, or characters, are worked on together.
TEXT_BYTES = 1 << 21
# Bytes of text that are encoded together: a token takes some ten times the bytes of its text meanwhile.
ENCODE_BYTES = 1 << 19
# Positions that a pass scans together.
SCAN_TOKENS = 1 << 20
# No token, among tokens held as int64.
NONE = -(1 << 40)
# Marks a special text among the pieces: a standard piece holds no line feed
# unless it is one.
SPECIAL_MARK = "\n"


def merge_once(tokens: list[int | None], merges: dict[tuple[int, int], int]) -> list[int | None] | None:
    """One pass of the any-pair rule, or None if no neighbours merge.

    Positions whose pair is in the table form runs; in each run the first, third,
    fifth … pair is replaced.
    """
    found = [merges.get(pair) for pair in zip(tokens, tokens[1:])]
    if all(new is None for new in found):
        return None
    place = accumulate(found, lambda n, new: 0 if new is None else n + 1, initial=0)
    taken = [n % 2 == 1 for n in place][1:]
    return [new if take else token for token, new, take, eaten in
            zip(tokens, [*found, None], [*taken, False], [False, *taken]) if not eaten]


class MergeTable:
    """Pairs of tokens -> new tokens, looked up for many pairs at once."""

    def __init__(self, merges: dict[tuple[int, int], int]):
        rows = sorted(((a << 32) + b, new) for (a, b), new in merges.items())
        self._keys, self._new = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The new token of each pair; NONE for a pair that is not in the table."""
        if not len(self._keys):
            return np.full(len(first), NONE)
        known = (first != NONE) & (second != NONE)
        pair = np.where(known, (first << 32) + second, 0)
        at = np.minimum(np.searchsorted(self._keys, pair), len(self._keys) - 1)
        return np.where(known & (self._keys[at] == pair), self._new[at], NONE)

    def scan(self, flat: np.ndarray, sizes: np.ndarray, step: int = SCAN_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:func:`merge_once` over sequences that lie one behind the other in ``flat``, ``step`` positions
        at a time: ``(found, tokens, kept)`` of each position, the new token of its pair, the
        token after the pass, and whether it stays. What reaches a step is the last position
        without a pair, and whether the position before was taken."""
        last = np.zeros(len(flat), bool)
        last[(np.cumsum(sizes) - 1)[sizes > 0]] = True
        found, kept = np.full(len(flat), NONE), np.ones(len(flat), bool)
        tokens = flat.copy()
        miss, taken = -1, False
        for lo in range(0, len(flat), step):
            hi = min(lo + step, len(flat))
            here = found[lo:hi]
            ends = min(hi, len(flat) - 1)
            here[:ends - lo] = self.find(flat[lo:ends], flat[lo + 1:ends + 1])
            here[last[lo:hi]] = NONE
            at = np.arange(lo, hi)
            since = np.maximum(np.maximum.accumulate(np.where(here == NONE, at, -1)), miss)
            pick = (here != NONE) & ((at - since) % 2 == 1)
            tokens[lo:hi][pick] = here[pick]
            kept[lo:hi] = ~np.concatenate([[taken], pick[:-1]])
            miss, taken = int(since[-1]), bool(pick[-1])
        return found, tokens, kept

    def fixpoint(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passes over every sequence until none of its neighbours merge: tokens and new sizes."""
        ids, total = np.arange(len(sizes)), len(sizes)
        if not len(self._keys):
            return flat, sizes
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(ids):
            found, tokens, kept = self.scan(flat, sizes)
            seq = np.repeat(np.arange(len(ids)), sizes)
            some = np.zeros(len(ids), bool)
            some[seq[found != NONE]] = True
            going = some[seq]
            done.append((ids[~some], flat[~going], sizes[~some]))
            keep = going & kept
            flat, sizes, ids = tokens[keep], np.bincount(seq[keep], minlength=len(ids))[some], ids[some]
        if not total:
            return flat, sizes
        order, tokens, lengths = (np.concatenate(x) for x in zip(*done))
        back = np.argsort(order)
        return tokens[ranges((np.cumsum(lengths) - lengths)[back], lengths[back])], lengths[back]


def ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``begin[i] … begin[i] + sizes[i] - 1`` for each i, one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + sizes, sizes)


def code_points(texts: Iterable[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


def text_code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts one behind the other, and how many each has; NULL has none."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    codes = np.frombuffer(bytes(text_buffers(texts)[0]).decode().encode("utf-32-le"), np.uint32)
    return codes, pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def char_table(ids: dict[str, int]) -> np.ndarray:
    """Code point -> token, NONE for an unknown character."""
    table = np.full(0x110000, NONE)
    for text, token in ids.items():
        if len(text) == 1:
            table[ord(text)] = token
    return table


def as_lists(flat: np.ndarray, sizes: np.ndarray, null: pa.Array | None = None) -> pa.Array:
    """Tokens and sizes as an array of lists; rows of ``null`` are NULL."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    unknown = flat == NONE
    values = pa.array(np.where(unknown, 0, flat).astype(np.int32), pa.int32(), mask=unknown)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=null)


def list_sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


class PieceEncoder:
    """Codes of pieces: a piece's own token, else its characters merged to a fixpoint."""

    def __init__(self, ids: dict[str, int], merges: dict[tuple[int, int], int]):
        self.ids, self.merges, self.chars = ids, MergeTable(merges), char_table(ids)
        self.texts = pa.array(list(ids), pa.string())
        # The last one stands for pieces that are no text of the vocabulary.
        self.tokens = np.array([*ids.values(), NONE], np.int64)

    def _whole(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The token of each piece that is a text of the vocabulary or a special (else NONE), and whether it is neither."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.texts), len(self.texts)).to_numpy(zero_copy_only=False)
        whole, is_split = self.tokens[at], at == len(self.texts)
        marked = pc.and_(pc.starts_with(pieces, SPECIAL_MARK), pc.greater(pc.binary_length(pieces), 1)).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(marked):
            whole[i], is_split[i] = self.ids.get(pieces[i].as_py()[1:], NONE), False
        return whole, is_split

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all pieces one behind the other, and how many each has."""
        whole, is_split = self._whole(pieces)
        codes, lengths = text_code_points(pieces.filter(pa.array(is_split)))
        flat, lengths = self.merges.fixpoint(self.chars[codes], lengths)
        sizes = np.ones(len(whole), np.int64)
        sizes[is_split] = lengths
        out = np.empty(int(sizes.sum()), np.int64)
        mine = np.repeat(is_split, sizes)
        out[mine] = flat
        out[~mine] = whole[~is_split]
        return out, sizes

    def __call__(self, piece: str) -> list[int | None]:
        return [None if c == NONE else c for c in self.encode(pa.array([piece]))[0].tolist()]


def lookup_lists(lists: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """A list of strings per row -> the concatenated code lists, null for a null row."""
    encoded = lists.flatten().dictionary_encode()
    flat, sizes = encode(encoded.dictionary)
    at = encoded.indices.to_numpy(zero_copy_only=False)
    mine = sizes[at] if len(at) else np.zeros(0, np.int64)
    begin = (np.cumsum(sizes) - sizes)[at] if len(at) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(mine)])
    rows = np.diff(ends[np.concatenate([[0], np.cumsum(list_sizes(lists))])])
    return as_lists(flat[ranges(begin, mine)], rows, lists.is_null() if lists.null_count else None)


def in_slices(batch: pa.RecordBatch, column: int, items: int | None = None) -> Iterator[pa.RecordBatch]:
    """A batch by rows that hold about ``items`` list entries, or bytes of text, of ``column``; of lists
    of segments, the bytes of their texts."""
    array = batch.column(column)
    text = pa.types.is_string(array.type) or pa.types.is_large_string(array.type)
    sizes = pc.fill_null(pc.binary_length(array) if text else pc.list_value_length(array), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    if pa.types.is_list(array.type) and pa.types.is_struct(array.type.value_type) and array.type.value_type.get_field_index("text") >= 0:
        length = pc.fill_null(pc.binary_length(array.flatten().field("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])[ends]
    lo, items = 0, items or SLICE_ITEMS
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + items, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def map_slices(df: DataFrame, column: str, schema: StructType, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
               items: int | None = None) -> DataFrame:
    """``df``, whose last column is ``column``, through a function of Arrow batches to the columns of
    ``schema``. A batch is worked on in slices, so that a task's memory does not follow the
    size of a batch of long documents."""
    names = [f.name for f in schema.fields]
    require(df.columns[-1] == column, f"{column} must be the last column")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in in_slices(batch, batch.num_columns - 1, items):
                yield pa.RecordBatch.from_arrays(fn(part), names)
    return df.mapInArrow(run, schema)


def _map_column(df: DataFrame, column: str, out: StructField, make: Callable[[], Callable[[pa.Array], pa.Array]],
                items: int | None = None) -> DataFrame:
    """``df`` with ``column`` (always the last) replaced by an Arrow function of it."""
    keys = [f for f in df.schema.fields if f.name != column]

    def make_batch():
        fn = make()
        return lambda batch: [*batch.columns[:-1], fn(batch.column(batch.num_columns - 1))]
    return map_slices(df.select(*[F.col(f"`{f.name}`") for f in keys], column), column, StructType([*keys, out]), make_batch, items)


TOKENS = StructField("tokens", ArrayType(IntegerType()))


def text_ids(vocab: DataFrame) -> dict[str, int]:
    """Text -> token on the driver; the largest id wins where tokens share a text."""
    require_columns(vocab, ["token", "text"], "text_ids")
    rows = collect_checked(vocab.groupBy("text").agg(F.max("token").alias("token")), "the vocabulary")
    return {r["text"]: r["token"] for r in rows}


def marked_lists(segments: pa.Array) -> pa.Array:
    """The pieces of each list of segments, specials marked; null for a null row."""
    pieces, special, sizes = split_segments(segments)
    if special.any():
        pieces = pc.if_else(pa.array(special), pc.binary_join_element_wise(SPECIAL_MARK, pieces, ""), pieces)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pieces, mask=segments.is_null() if segments.null_count else None)


def encode_lists(df: DataFrame, column: str, vocab: DataFrame, merges: DataFrame | None) -> DataFrame:
    """``df`` with the piece lists, or segments ``array<struct<text, special>>``, in ``column`` replaced by ``tokens array<int>``."""
    ids = text_ids(vocab)
    table = {} if merges is None else merge_table(merges)
    shared = ship(df.sparkSession, (ids, table), text_bytes(ids) + 128 * len(table), "the tokenizer")

    def make():
        encoder = PieceEncoder(*shared.value)
        return lambda lists: lookup_lists(marked_lists(lists) if pa.types.is_struct(lists.type.value_type) else lists, encoder.encode)
    segments = isinstance(df.schema[column].dataType.elementType, StructType)
    return _map_column(df, column, TOKENS, make, ENCODE_BYTES if segments else None)


def merge_table(merges: DataFrame) -> dict[tuple[int, int], int]:
    """Pair -> new token on the driver."""
    rows = collect_checked(merges.select("t1", "t2", "new_token"), "the merge table")
    return {(r["t1"], r["t2"]): r["new_token"] for r in rows}


def lookup_chars(df: DataFrame, column: str, vocab: DataFrame, strict: bool) -> DataFrame:
    """``df`` with the text in ``column`` replaced by ``tokens``, one a character; a character
    without a token is NULL, or with ``strict`` fails the job. A NULL text has NULL tokens."""
    ids = text_ids(vocab)
    shared = ship(df.sparkSession, ids, text_bytes(ids), "the vocabulary")

    def make():
        known = char_table(shared.value)

        def look(texts: pa.Array) -> pa.Array:
            codes, sizes = text_code_points(texts)
            flat = known[codes]
            if strict and (flat == NONE).any():
                raise ValueError(f"character {chr(codes[flat == NONE][0])!r} is missing from the vocabulary")
            return as_lists(flat, sizes, texts.is_null() if texts.null_count else None)
        return look
    return _map_column(df, column, TOKENS, make)


def decode_lists(df: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """``df`` with the token lists in ``column`` replaced by ``text``, the texts joined.

    A NULL list gives NULL; a NULL or unknown token adds nothing.
    """
    rows = sorted((r["token"], r["text"]) for r in collect_checked(vocab.select("token", "text"), "the vocabulary"))
    tokens = np.array([t for t, _ in rows], np.int64)
    texts = [t for _, t in rows]
    shared = ship(df.sparkSession, (tokens, texts), text_bytes(texts), "the vocabulary")

    def make():
        known, text = shared.value
        every = pa.array([*text, ""], pa.string())  # the last one stands for unknown tokens

        def decode(lists: pa.Array) -> pa.Array:
            lengths = list_sizes(lists)
            flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            parts = every.take(pa.array(np.where(hit, at, len(text))))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, parts), "")
            return pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.string()))
        return decode
    return _map_column(df, column, StructField("text", StringType()), make)
