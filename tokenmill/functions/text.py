"""Column expressions for the text side: space marking, pieces, specials.

Nearly everything here is a built-in Spark expression (regex, translate, HOFs),
so it runs inside whole-stage codegen on the executors; only very many specials are found
by an automaton in Arrow batches.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..validation import require

# ---------------------------------------------------------------------------
# Fixed values (must equal the tokenizer being reproduced).
# Visible-space marker used in vocabulary texts:
SPACE_MARK = "Ġ"  # 'Ġ'
# End-of-text special token text:
EOT = "<|endoftext|>"
# Whitespace that is neither space, CR nor LF (the Unicode whitespace set of
# Python's `\s` minus those three): dropped between pieces when encoding.
OTHER_WHITESPACE = (
    "\t\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Number of base tokens: ids 0..255 are the characters chr(0)..chr(255).
N_BASE = 256
# ---------------------------------------------------------------------------

# More specials than this are found by an automaton: an alternation tries them one by one at each character.
AUTOMATON = 64
# Character class of OTHER_WHITESPACE, for Java's and Arrow's patterns.
OTHER_WS_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in OTHER_WHITESPACE) + "]"


def preprocess_text(text: Column) -> Column:
    """:func:`preprocess_chars` as one string."""
    return F.replace(F.when(F.startswith(text, F.lit(" ")), F.substring(text, 2, 2**31 - 1)).otherwise(text), F.lit(" "), F.lit(SPACE_MARK))


def preprocess_chars(text: Column) -> Column:
    """Training-time characters: a space at position 0 is dropped, every other
    space becomes the marker; other whitespace is kept as a character.
    Returns ``array<string>`` (empty for an empty text)."""
    marked = preprocess_text(text)
    return F.when(F.length(marked) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(marked, ""))


def split_pieces(text: Column) -> Column:
    """Encode-time pieces of one standard segment.

    CR and LF are pieces of their own (CRLF gives two); a run of n spaces
    before a word gives n-1 lone markers and the word with one marker in
    front; trailing spaces give one marker each; other whitespace separates
    words but is dropped and does not count as a space.
    """
    e1 = F.regexp_replace(text, OTHER_WS_CLASS, "\t")
    # Inside a mixed run of spaces and other whitespace only the spaces count.
    # A match can start only at the head of a run of tabs: without the
    # look-behind every tab of a long run would be tried as a start.
    e2 = F.regexp_replace(e1, "(?<!\t)\t+ \t*| \t*", " ")
    raw = F.regexp_extract_all(e2, F.lit("(\r|\n| ?[^ \t\r\n]+| )"), F.lit(1))
    return F.transform(raw, lambda p: F.replace(p, F.lit(" "), F.lit(SPACE_MARK)))


def unmark(text: Column) -> Column:
    """Decode-time text: the marker becomes a space again."""
    return F.replace(text, F.lit(SPACE_MARK), F.lit(" "))


def _java_quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _special_alternation(specials: Sequence[str]) -> str:
    require(all(len(s) > 0 for s in specials), "special token texts must be non-empty")
    # Longest first, so that a special that contains another one wins.
    ordered = sorted(dict.fromkeys(specials), key=len, reverse=True)
    return "|".join(_java_quote(s) for s in ordered)


def _cut_at(text: str, found: list[tuple[int, int]], mode: str) -> list[dict]:
    """Segments of a text with specials at ``found`` (start, end), by the rules of :func:`special_segments`."""
    out, at, leading = [], 0, True
    for start, end in found:
        leading = leading and start == at
        if mode == "all" or leading:
            if start > at:
                out.append({"text": text[at:start], "special": False})
            out.append({"text": text[start:end], "special": True})
            at = end
        elif start > at:
            out.append({"text": text[at:start], "special": False})
            at = start
    if at < len(text):
        out.append({"text": text[at:], "special": False})
    return out


def special_segments_many(text: Column, specials: Sequence[str], mode: str = "all") -> Column:
    """:func:`special_segments` for any number of specials: an Aho-Corasick automaton finds the
    leftmost longest occurrences in one pass over the text. The list of specials goes to
    every task. NULL for NULL."""
    require(mode in ("all", "leading"), f"unknown special_mode {mode!r}")
    require(all(len(s) > 0 for s in specials), "special token texts must be non-empty")
    words = list(dict.fromkeys(specials))

    @F.pandas_udf("array<struct<text:string,special:boolean>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for w in words:
            automaton.add_word(w, len(w))
        if words:
            automaton.make_automaton()
        for batch in batches:
            yield batch.map(lambda t: None if t is None else _cut_at(
                t, [(end + 1 - n, end + 1) for end, n in automaton.iter_long(t)] if words else [], mode))
    return run(text)


def special_segments(text: Column, specials: Sequence[str], mode: str = "all") -> Column:
    """Split a text into ``array<struct<text:string, special:boolean>>``.

    ``mode='all'``: every occurrence of a special text is its own special
    segment. ``mode='leading'``: only a leading run of specials is recognised;
    afterwards each later special starts a standard segment together with the
    text that follows it (the literal behaviour of the reproduced splitter).
    No specials: the whole text is one standard segment; empty text: none.
    """
    require(mode in ("all", "leading"), f"unknown special_mode {mode!r}")
    seg_type = "array<struct<text:string,special:boolean>>"
    empty = F.array().cast(seg_type)
    if len(specials) > AUTOMATON:
        return special_segments_many(text, specials, mode)
    whole = F.array(F.struct(text.alias("text"), F.lit(False).alias("special")))
    if not specials:
        return F.when(F.length(text) == 0, empty).otherwise(whole)
    # Most texts hold no special: a search is much cheaper than the patterns.
    without = (F.length(text) > 0) & ~reduce(lambda a, b: a | b, [F.contains(text, F.lit(s)) for s in specials])
    return F.when(without, whole).otherwise(_cut_by_patterns(text, specials, mode))


def _cut_by_patterns(text: Column, specials: Sequence[str], mode: str) -> Column:
    """:func:`special_segments` by regular expressions."""
    alt = _special_alternation(specials)
    spec_arr = F.array(*[F.lit(s) for s in specials])
    if mode == "all":
        parts = F.regexp_extract_all(text, F.lit(f"(?s)({alt}|.+?(?={alt}|\\z))"), F.lit(1))
        return F.transform(parts, lambda p: F.struct(
            p.alias("text"), F.array_contains(spec_arr, p).alias("special")))
    head = F.regexp_extract_all(
        F.regexp_extract(text, f"^((?:{alt})*)", 1), F.lit(f"({alt})"), F.lit(1))
    rest = F.regexp_replace(text, f"^(?:{alt})*", "")
    tail = F.regexp_extract_all(
        rest, F.lit(f"(?s)((?:{alt}).*?(?={alt}|\\z)|.+?(?={alt}|\\z))"), F.lit(1))
    return F.concat(
        F.transform(head, lambda p: F.struct(p.alias("text"), F.lit(True).alias("special"))),
        F.transform(tail, lambda p: F.struct(p.alias("text"), F.lit(False).alias("special"))),
    )


def segment_pieces(segments: Column) -> Column:
    """Pieces of all segments, in order: ``array<struct<piece, special>>``.
    A special segment is one piece; a standard one is split by
    :func:`split_pieces` (pending spaces never cross a segment)."""
    return F.flatten(F.transform(segments, lambda s: F.when(
        s["special"], F.array(F.struct(s["text"].alias("piece"), F.lit(True).alias("special"))),
    ).otherwise(F.transform(split_pieces(s["text"]), lambda p: F.struct(
        p.alias("piece"), F.lit(False).alias("special"))))))


def ints_to_text(arr: Column, sep: str = " ") -> Column:
    """Render an int array as a separator-joined string (for reports/oracles)."""
    return F.array_join(arr.cast("array<string>"), sep)
