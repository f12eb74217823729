"""Byte-level BPE of whole texts by a global shuffle of distinct words, and decoding.

Texts are split into pre-tokens ("words") by the tokenizer's pattern in the JVM. A task
keeps its documents together in *chunks* of about ``CHUNK_WORDS`` words: a chunk has a
dictionary of its distinct words, and each document is the list of dictionary places of
its words, in order. Then

1. the dictionaries' words are shuffled by a hash of the word. The words of a chunk with
   the same bucket of the hash travel as one row, with their places in the dictionary. A
   word is in a chunk's dictionary once, however often it occurs, so no word is hot;
2. each distinct word is encoded once, in its bucket, and its ids join every row that
   holds the word;
3. ids and documents meet again by chunk, and documents are put together by position.

The word rows and the document rows come from two runs of one function over the input,
so that the much larger document rows are shuffled once and never written. A chunk's
name is a hash of its content. An input that changes between the runs (a frame that is
not deterministic) is an error, not a wrong result: write such a frame to a table first.

Decoding looks ids up in the table of token bytes, in the JVM. The table has one entry an
id of the rank file, whose size is checked, so it goes to all tasks.
"""
from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from ..validation import require
from .common import packed, unpacked

#: Words of a chunk, about, and bytes at which it ends earlier.
CHUNK_WORDS, CHUNK_BYTES = 1 << 21, 1 << 27
#: Buckets that distinct words are shuffled to, for each shuffle partition. The words of a
#: bucket are kept while it is encoded.
BUCKETS = 4
#: A rank file beyond this is refused: its table goes to all tasks.
RANK_FILE_BYTES = 64 << 20
#: A word of more bytes is merged with a heap.
SHORT = 64
#: White space as the pattern's \s has it; Java's own \s knows ASCII only.
_SPACES = r"\t-\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_NEVER = 1 << 62
#: Follows every word on its way from the JVM.
_MARK = "\x01"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines ``base64 rank``. Every single byte must be a token."""
    require(os.path.getsize(path) <= RANK_FILE_BYTES, f"a rank file has at most {RANK_FILE_BYTES} bytes")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    require(all(bytes([b]) in ranks for b in range(256)), "every single byte must have a rank")
    return ranks


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: its own id if it is a token, else its bytes with the neighbours of
    lowest rank joined, the leftmost first, while there are any."""
    own = ranks.get(word)
    if own is not None:
        return [own]
    if len(word) > SHORT:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pair = [ranks.get(word[i:i + 2], _NEVER) for i in range(len(word) - 1)]
    while pair and (low := min(pair)) < _NEVER:
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], _NEVER)
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], _NEVER)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As :func:`merge`, with a heap of pairs over a linked list."""
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once it is part of another
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            stop = end[end[i]]
            if (r := ranks.get(word[i:stop])) is not None:
                heapq.heappush(heap, (r, i, stop))

    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of its parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
        offer(i)
        offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def split_pattern(pattern: str) -> str:
    """``pattern`` for the JVM, whose own ``\\s`` knows ASCII only."""
    return (pattern.replace(r"[^\s", "[^" + _SPACES).replace(r"\s", f"[{_SPACES}]")
            .replace(r"\S", f"[^{_SPACES}]"))


def split_unknown(text: str, pattern: str) -> list[str]:
    """Pre-tokens of a text with code points that are newer than the JVM: the tokenizer
    library tells each one's class, a stand-in of that class takes its place for the split."""
    import regex  # seldom needed, so tasks do without
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    stand_in = {}
    chars = "".join({c for c in text if ord(c) > 0x377})
    for klass, char in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " ")):
        e = tiktoken.Encoding("class", pat_str=klass, mergeable_ranks=single, special_tokens={})
        stand_in.update(dict.fromkeys(e.decode(e.encode_ordinary(chars)), char))
    plain = "".join(c if ord(c) <= 0x377 else stand_in.get(c, "†") for c in text)
    return [text[m.start():m.end()] for m in regex.finditer(pattern, plain)]


def to_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, ends)``: values below 2^28 as seven bits a byte, low bits first; ``ends`` of each."""
    v = values.astype(np.uint32)
    size = 1 + (v >= 1 << 7).astype(np.int64) + (v >= 1 << 14) + (v >= 1 << 21)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - size
    for k in range(4):
        at = np.flatnonzero(size > k)
        out[starts[at] + k] = (v[at] >> np.uint32(7 * k) & np.uint32(127)) | np.where(size[at] > k + 1, 128, 0).astype(np.uint32)
    return out, ends


def from_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(values, ends)`` of :func:`to_varints`."""
    last = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], last[:-1] + 1]).astype(np.int64) if len(last) else last
    size = last - starts + 1
    out = (data[starts] & 127).astype(np.int64)
    for k in range(1, 4):
        at = np.flatnonzero(size > k)
        out[at] |= (data[starts[at] + k] & 127).astype(np.int64) << 7 * k
    return out, last + 1


def _sliced(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binaries of the varints of ``values[cuts[i]:cuts[i + 1]]``."""
    data, ends = to_varints(values)
    offsets = np.concatenate([[0], ends])[cuts].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _unsliced(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(values, number in each binary)`` of :func:`_sliced`."""
    parts = column.to_pylist()
    values, ends = from_varints(np.frombuffer(b"".join(parts), np.uint8))
    stops = np.searchsorted(ends, np.cumsum([len(p) for p in parts]), side="right")
    return values, np.diff(stops, prepend=0)


def _words(batch: pa.RecordBatch, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """``(words, number of each row)`` of a batch; each word with its mark at the end."""
    marked, texts = batch.column("marked"), batch.column("text")
    if texts.null_count < len(texts):
        rows = [(m[:-1].split(_MARK) if m else []) if t is None else split_unknown(t, pattern)
                for m, t in zip(marked.to_pylist(), texts.to_pylist())]
        words = pa.array([(w + _MARK).encode() for r in rows for w in r], pa.binary())
        return words, np.array([len(r) for r in rows], np.int64)
    at = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset:marked.offset + len(marked) + 1]
    data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    ends = np.flatnonzero(data == ord(_MARK)) + 1
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return words, np.diff(np.searchsorted(ends, at - at[0], side="right"))


def _chunks(batches: Iterator[pa.RecordBatch], pattern: str, words: int) -> Iterator[tuple]:
    """``(name, dictionary, places, words of each document, rows)`` of each chunk. A chunk ends with
    the document that gives it enough words or bytes, wherever a batch ends."""
    held: list[tuple[pa.Array, np.ndarray, pa.RecordBatch]] = []
    held_words = held_bytes = 0

    def close() -> tuple:
        coded = pa.concat_arrays([w for w, _, _ in held]).dictionary_encode()
        places, each = coded.indices.to_numpy(zero_copy_only=False), np.concatenate([n for _, n, _ in held])
        h = xxhash.xxh3_64(each.tobytes())
        for part in (places, *[x for x in coded.dictionary.buffers()[1:] if x is not None]):
            h.update(part)
        return h.intdigest() - (1 << 63), coded.dictionary, places, each, [r for _, _, r in held]

    for batch in batches:
        flat, sizes = _words(batch, pattern)
        rows = batch.select([n for n in batch.schema.names if n == "__row"])
        weights = np.concatenate([[0], np.cumsum(batch.column("n_bytes").to_numpy(zero_copy_only=False).astype(np.int64))])
        counts = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(sizes):
            full = (counts[at + 1:] - counts[at] + held_words >= words) | (weights[at + 1:] - weights[at] + held_bytes >= CHUNK_BYTES)
            end = at + int(full.argmax()) + 1 if full.any() else len(sizes)
            held.append((flat.slice(int(counts[at]), int(counts[end] - counts[at])), sizes[at:end], rows.slice(at, end - at)))
            held_words += int(counts[end] - counts[at])
            held_bytes += int(weights[end] - weights[at])
            if full.any():
                yield close()
                held, held_words, held_bytes = [], 0, 0
            at = end
    if held:
        yield close()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           keep: Sequence[str] = ("doc_id",), words: int = CHUNK_WORDS) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``ids`` (array of int), one row a row of ``docs``.

    Every match of ``pattern`` in a text is encoded separately, without special tokens; the
    matches must cover every text. A
    null text is empty; an empty text has no ids. Repeated rows and ids stay; the columns
    kept may have any name but ``ids``. ``docs`` must give the same rows in the same order
    when read twice, as tables do.
    """
    require("ids" not in [k.lower() for k in keep], "a column to keep may not be called ids")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    buckets = BUCKETS * max(256, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    row = F.struct(*[F.col(f"`{k}`") for k in keep]) if keep else F.struct(F.lit(0))

    def split(*more: Column) -> DataFrame:
        # Texts with the mark, or code points that the JVM's tables don't know, are left to split_unknown.
        t = docs.select(*more, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
        t = t.withColumn("__new", F.col("__text").rlike(r"[\p{Cn}" + _MARK + "]"))
        marked = F.regexp_replace("__text", F.lit(split_pattern(pattern)), F.lit("$0" + _MARK))
        return t.select(*[c for c in t.columns if c == "__row"], F.when(~F.col("__new"), marked).alias("marked"),
                        F.when(F.col("__new"), F.col("__text")).alias("text"),
                        F.octet_length("__text").cast("long").alias("n_bytes"))

    def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, dictionary, _, _, _ in _chunks(batches, pattern, words):
            n = len(dictionary)
            bucket = np.fromiter(map(crc32, dictionary.to_pylist()), np.int64, n) % buckets
            order = np.argsort(bucket, kind="stable")
            used, first = np.unique(bucket[order], return_index=True)
            cuts = np.append(first, n)
            step = np.diff(order, prepend=0)
            step[first] = order[first]  # the first place of a bucket, then the distances
            dealt = dictionary.take(pa.array(order))
            lengths = pc.binary_length(dealt).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(lengths)])[cuts].astype(np.int32)
            joined = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(at.tobytes()), dealt.buffers()[2]])
            yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(np.full(len(used), name, np.int64)), _sliced(step, cuts),
                                   _sliced(lengths, cuts), joined], ["bucket", "chunk", "places", "lengths", "words"])

    def document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, places, each, rows in _chunks(batches, pattern, words):
            codes = _sliced(places, np.concatenate([[0], np.cumsum(each)]))
            at = 0
            for r in rows:
                part = codes.slice(at, r.num_rows)
                at += r.num_rows
                yield pa.record_batch([pa.array(np.full(r.num_rows, name, np.int64)), r.column("__row"), part], ["chunk", "__row", "codes"])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, now, known = shared.value, None, {}
        for b in batches:
            sizes, ids, cuts, id_cuts = [], [], [0], [0]
            lengths, n_words = _unsliced(b.column("lengths"))
            stops, at = np.cumsum(n_words).tolist(), 0
            for bucket, joined, stop in zip(b.column("bucket").to_pylist(), b.column("words").to_pylist(), stops):
                if bucket != now:
                    now, known = bucket, {}
                start = 0
                for n in lengths[at:stop].tolist():
                    w = joined[start:start + n]
                    start += n
                    found = known.get(w)
                    if found is None:
                        found = known[w] = merge(w[:-1], table)
                    sizes.append(len(found))
                    ids += found
                at = stop
                cuts.append(len(sizes))
                id_cuts.append(len(ids))
            yield pa.record_batch([b.column("chunk"), b.column("places"), _sliced(np.array(sizes, np.int64), np.array(cuts)),
                                   _sliced(np.array(ids, np.int64), np.array(id_cuts))], ["chunk", "places", "sizes", "ids"])

    def assemble(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
        codes, n_codes = _unsliced(documents.column("codes"))
        steps, n_steps = _unsliced(dictionary.column("places"))
        sizes, (ids, _) = _unsliced(dictionary.column("sizes"))[0], _unsliced(dictionary.column("ids"))
        # Places are sums of the distances in their row.
        before = np.concatenate([[0], np.cumsum(steps)])
        starts = np.concatenate([[0], np.cumsum(n_steps)])[:-1]
        at = before[1:] - np.repeat(before[starts], n_steps)
        where = np.full(int(codes.max(initial=-1)) + 1, -1, np.int64)
        known = np.flatnonzero(at < len(where))
        where[at[known]] = known
        if len(where) and where.min() < 0:
            raise ValueError("the documents changed between two readings; write them to a table first")
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids.astype(np.int32)))
        found = lists.take(pa.array(where[codes]))
        ends = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
        offsets = ends[np.concatenate([[0], np.cumsum(n_codes)])]
        return pa.table({"__row": documents.column("__row").combine_chunks(),
                         "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), found.flatten())})

    kept = split(row.alias("__row"))
    row_type = kept.schema["__row"]
    words_of = split().mapInArrow(word_rows, "bucket int, chunk long, places binary, lengths binary, words binary")
    ids_of = words_of.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        encode_words, "chunk long, places binary, sizes binary, ids binary")
    coded = kept.mapInArrow(document_rows, StructType([StructField("chunk", LongType()), row_type, StructField("codes", BinaryType())]))
    out = coded.groupBy("chunk").cogroup(ids_of.groupBy("chunk")).applyInArrow(
        assemble, StructType([row_type, StructField("ids", ArrayType(IntegerType()))]))
    return out.select(*[F.col("__row").getField(k).alias(k) for k in keep], "ids")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``: the bytes of ``ids`` joined (binary). No ids give no bytes,
    null ids null, and so does a list that holds a null or an id that is no token. An input
    column called ``out`` is replaced. The token bytes are a constant array in the plan,
    as hexadecimal text, which the JVM looks ids up in."""
    by_id = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token.hex()
    table = F.split(F.lit(",".join(by_id)), ",")
    before = packed(encoded, F.transform(F.col(f"`{ids}`"), lambda i: F.get(table, i.cast("int"))).alias("parts"))
    whole = F.forall("parts", lambda p: F.coalesce(p != "", F.lit(False)))
    return unpacked(before, encoded, **{out: F.when(whole, F.unhex(F.array_join("parts", "")))})
