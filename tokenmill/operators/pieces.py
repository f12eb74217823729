"""Pieces of texts in Arrow batches: the rules of :func:`..functions.text.split_pieces` on the bytes
of many texts at once, so that no pattern is tried and no object made a piece."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.text import OTHER_WHITESPACE, OTHER_WS_CLASS, SPACE_MARK

WORD, SPACE, DROPPED, BREAK = range(4)
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(" "), ord("\t"), ord("\r"), ord("\n")]] = SPACE, DROPPED, BREAK, BREAK
# First bytes of the white space that is dropped, the tab aside.
_MAYBE_DROPPED = np.zeros(256, bool)
_MAYBE_DROPPED[[c.encode()[0] for c in OTHER_WHITESPACE if c != "\t"]] = True
_MARK = SPACE_MARK.encode()


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without NULL, one behind the other, and where each starts and the last one ends."""
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def split_texts(texts: pa.Array, special: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts one behind the other, and how many each text has. A text that is
    ``special`` is one piece as it stands. NULL has no pieces."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if special is not None and not special.any():
        special = None
    data, at = text_buffers(texts)
    if _MAYBE_DROPPED[data].any():
        tabs = pc.replace_substring_regex(texts, OTHER_WS_CLASS, "\t")
        data, at = text_buffers(tabs if special is None else pc.if_else(pa.array(special), texts, tabs))
    kind = _KIND[data]
    if special is not None:
        kind[np.repeat(special, np.diff(at))] = WORD
    apart = None
    dropped = kind == DROPPED
    if dropped.any():
        # What is dropped parts two words; next to a space it counts for nothing.
        keep = ~dropped
        apart = np.concatenate([[False], dropped[:-1]])[keep]
        at = np.concatenate([[0], np.cumsum(keep)])[at]
        data, kind = data[keep], kind[keep]
    before = np.concatenate([np.full(1, BREAK, np.uint8), kind[:-1]])[:len(kind)]
    starts = (kind != WORD) | (before == BREAK)
    if apart is not None:
        starts |= apart & (before == WORD)
    starts[at[:-1][np.diff(at) > 0]] = True
    first = np.flatnonzero(starts)
    space = kind == SPACE
    spaces = np.cumsum(space, dtype=np.int32)
    moved = np.arange(len(data), dtype=np.int32) + spaces - space
    out = np.full(len(data) + (int(spaces[-1]) if len(spaces) else 0), _MARK[1], np.uint8)
    out[moved] = np.where(space, np.uint8(_MARK[0]), data)
    offsets = np.concatenate([moved[first], [len(out)]]).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    return pieces, np.diff(np.searchsorted(first, at))


def split_segments(segments: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of lists of segments (text, special): all pieces, whether each is special, and how many each list has."""
    flat = segments.flatten()
    special = flat.field("special").to_numpy(zero_copy_only=False).astype(bool)
    pieces, sizes = split_texts(flat.field("text"), special)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    lists = pc.fill_null(pc.list_value_length(segments), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return pieces, np.repeat(special, sizes), np.diff(ends[np.concatenate([[0], np.cumsum(lists)])])
