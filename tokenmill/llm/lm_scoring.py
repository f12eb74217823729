"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

Vocabulary. Words are counted over all training texts in Spark. The ``MODEL_WORDS``
most frequent ones (the end of a text among them) are outputs and contexts of the
model by themselves; every other word belongs to one of ``CLASSES`` classes by its last two
bytes, and a class is an output and a context too.

Model. The context vector of a word is predicted as ``r C`` and scored against every
output, ``(r_h C) . q_w + b_w``. Parameters are learned in numpy by noise-contrastive
estimation with ``NOISE`` noise words for each observed pair from the unigram
distribution. Pairs are counted over all training texts in Spark; as the noise
distribution is known, each step uses its expectation instead of samples, so learning
is deterministic. The pair table has at most ``(MODEL_WORDS + CLASSES) ** 2`` cells.

Scores. Batched matrix products give all contexts' logits, whose log-sum-exp
normalises every token's probability exactly. A word of a class has the class's
probability times ``(c + 1) / (N_u + V_u + 1)`` with its count c and the class's tokens
and distinct words in training; all words never seen share the rest.

Counts. The ``HEAD`` most frequent words are shipped to the executors (a bounded
table); only words beyond it, which are rare, are joined by shuffle, one row for each
distinct word of a text.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Stands for the end of a text; it holds white space, so no word equals it.
END = b"\n"
MODEL_WORDS, CLASSES = 1984, 64
#: Words whose counts are shipped to the executors.
HEAD = 1 << 18
DIMENSIONS, NOISE, STEPS, RATE, SEED = 32, 10, 60, 0.08, 7
#: Contexts of one matrix product.
ROWS = 512
FOLDS, HELD_OUT = 7, 2


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case (bytes know only ASCII case and white space), then the end."""
    return (text.encode("utf-8", "surrogatepass").lower().split() if text else []) + [END]


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def fold(id_col: Column) -> Column:
    """Checksum of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % FOLDS


class LogBilinear:
    """Parameters over ``size`` outputs, learned from a dense table of pair counts."""

    def __init__(self, pairs: np.ndarray, dimensions: int = DIMENSIONS, noise: int = NOISE, steps: int = STEPS,
                 rate: float = RATE, seed: int = SEED):
        size = len(pairs)
        rng = np.random.default_rng(seed)
        total = max(1.0, float(pairs.sum()))
        q = ((pairs.sum(axis=0) + 1) / (pairs.sum() + size)).astype(np.float32)  # the noise distribution
        context = (pairs.sum(axis=1) / total).astype(np.float32)
        p = {"r": rng.normal(0, 0.1, (size, dimensions)).astype(np.float32), "c": np.eye(dimensions, dtype=np.float32),
             "q": rng.normal(0, 0.1, (size, dimensions)).astype(np.float32), "b": np.log(q)}
        shift = np.log(noise * q)
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, steps + 1):
            g = {k: np.zeros_like(v) for k, v in p.items()}
            for at in range(0, size, ROWS):
                rows = slice(at, at + ROWS)
                h = p["r"][rows] @ p["c"]
                from_data = 1 / (1 + np.exp(shift - p["b"] - h @ p["q"].T))  # P(pair is data)
                # d/ds of  n log P + noise * n_h q log(1 - P),  per observed pair
                d = pairs[rows] / np.float32(total) * (1 - from_data) - noise * context[rows, None] * q * from_data
                g["b"] += d.sum(axis=0)
                g["q"] += d.T @ h
                dh = d @ p["q"]
                g["c"] += p["r"][rows].T @ dh
                g["r"][rows] = dh @ p["c"].T
            for k in p:  # Adam, towards larger values of the objective
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] += rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-10)
        self.p = p

    def log10_table(self) -> np.ndarray:
        return log10_table(self.p)


def log10_table(p: dict[str, np.ndarray]) -> np.ndarray:
    """Normalised log10 P(output | context) for all contexts, by batched matrix products."""
    out = np.empty((len(p["r"]), len(p["r"])), np.float32)
    for at in range(0, len(out), ROWS):
        logits = (p["r"][at:at + ROWS] @ p["c"]).astype(np.float64) @ p["q"].T.astype(np.float64) + p["b"]
        top = logits.max(axis=1, keepdims=True)
        out[at:at + ROWS] = (logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))) / np.log(10)
    return out


def count_words(texts: DataFrame) -> DataFrame:
    """``(word binary, n)`` over the one text column of ``texts``."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for t in batch.iloc[:, 0]:
                seen.update(tokens(t))
            yield pd.DataFrame({"word": list(seen.keys()), "n": np.fromiter(seen.values(), np.int64, len(seen))})
    return texts.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The head of the word counts, and what the classes hold besides the model's own words."""

    def __init__(self, words: list[bytes], counts: np.ndarray, class_tokens: np.ndarray, class_words: np.ndarray):
        """``words``: the model's own by falling count, the end first, then the others; class totals
        over all words of training."""
        self.words, self.counts = words, counts
        self.own = min(MODEL_WORDS, len(words))
        self.class_of = np.fromiter((word_class(w) for w in words), np.int64, len(words))
        mine = slice(0, self.own)
        n = class_tokens - np.bincount(self.class_of[mine], counts[mine], CLASSES)
        v = class_words - np.bincount(self.class_of[mine], minlength=CLASSES)
        #: log10 of N_u + V_u + 1
        self.class_log = np.log10(n + v + 1)
        self.size = self.own + CLASSES

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def outputs(self) -> np.ndarray:
        """The model output of each head word."""
        out = np.arange(len(self.words))
        out[self.own:] = self.own + self.class_of[self.own:]
        return out


def learn_vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """The model's words and the most frequent others, about ``head`` at most.

    The others are all words above a count; it is found from the number of words per
    class of counts (eight classes to a doubling), so nothing is sorted.
    """
    own = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(
        F.col("word") != F.lit(END), F.col("n").desc(), "word").limit(MODEL_WORDS).collect()]
    size = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(((r["size"], r["n"]) for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for c, n in sizes:
        total += n
        if total > head:
            break
        least = c
    known = {w for w, _ in own}
    words, n = [w for w, _ in own], [c for _, c in own]
    if least is not None:
        rest = counts.filter(size >= least).select("word", "n").toArrow()
        more = [(w, c) for w, c in zip(rest["word"].to_pylist(), rest["n"].to_pylist()) if w not in known]
        words += [w for w, _ in more]
        n += [c for _, c in more]
    by_class = counts.groupBy(_class_column(F.col("word")).alias("u")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens_of, words_of = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class:
        tokens_of[r["u"]], words_of[r["u"]] = r["n"], r["v"]
    return Vocabulary(words, np.array(n, np.int64), tokens_of, words_of)


def _class_column(word: Column) -> Column:
    # The last two bytes; substring(-2) of a single byte would be empty.
    return (F.crc32(F.when(F.octet_length(word) > 2, F.substring(word, -2, 2)).otherwise(word)) % CLASSES).cast("int")


def count_pairs(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Dense table of (context output, output) counts over the one text column of ``texts``."""
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary.words[:vocabulary.own], vocabulary.size))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, size = shared.value
        known = {w: i for i, w in enumerate(words)}
        own = len(words)
        for batch in batches:
            table = np.zeros(size * size, np.int64)
            for t in batch.iloc[:, 0]:
                ws = tokens(t)
                # known by itself, else by class; each class is looked up once a word
                ids = np.fromiter([known[w] if w in known else own + zlib.crc32(w[-2:]) % CLASSES for w in ws], np.int64, len(ws))
                before = np.concatenate([[known.get(END, own)], ids[:-1]])
                np.add.at(table, before * size + ids, 1)
            code = np.nonzero(table)[0]
            yield pd.DataFrame({"code": code.astype(np.int32), "n": table[code]})

    pairs = texts.mapInPandas(count, "code int, n long").groupBy("code").agg(F.sum("n").cast("float").alias("n")).toArrow()
    out = np.zeros(vocabulary.size ** 2, np.float32)
    for batch in pairs.to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.reshape(vocabulary.size, vocabulary.size)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, **training) -> DataFrame:
    """Per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of whole texts. A null or empty text is its end
    alone. A null id counts as the empty text in the fold; repeated rows count each in
    training and are scored each; without training texts the end and the classes are
    equally likely, and every count is 0; an empty table stays empty.
    """
    spark = docs.sparkSession
    held = fold(F.col(id_col)) == HELD_OUT
    train = docs.filter(~held).select(F.col(text_col).alias("text"))
    counts = materialise(count_words(train), "lm-counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    vocabulary = learn_vocabulary(counts, head)
    model = LogBilinear(count_pairs(train, vocabulary), **training)
    # Plain lists and arrays: the classes need not be importable on the executors.
    shared = spark.sparkContext.broadcast((vocabulary.words, vocabulary.counts, vocabulary.outputs(), vocabulary.class_of,
                                           vocabulary.class_log, vocabulary.own, model.p))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, n, outputs, class_of, class_log, own, parameters = shared.value
        index, outputs = {w: i for i, w in enumerate(head)}, np.append(outputs, 0)
        table = log10_table(parameters)
        base_log = np.append(np.log10(n + 1.0), 0.0)
        # A class word's share of its class; 0 for the model's own words and, for now, beyond the head.
        within = np.append(np.where(np.arange(len(head)) < own, 0.0, base_log[:-1] - class_log[class_of]), 0.0)
        end = index.get(END, None)
        start = outputs[end] if end is not None else own
        for batch in batches:
            rows = []
            for doc_id, held_out, text in zip(batch["id"], batch["held_out"], batch["text"]):
                ws = tokens(text)
                at = np.fromiter([index.get(w, -1) for w in ws], np.int64, len(ws))
                out = outputs[at]
                rare = np.nonzero(at < 0)[0]
                tail: Counter = Counter()
                if len(rare):
                    words = [ws[i] for i in rare.tolist()]
                    out[rare] = [own + zlib.crc32(w[-2:]) % CLASSES for w in words]
                    tail.update(words)
                before = np.concatenate([[start], out[:-1]])
                rows.append((doc_id, held_out, len(ws), len(ws) - len(rare), float(base_log[at].sum()),
                             float(table[before, out].sum(dtype=np.float64) + within[at].sum()),
                             list(tail.keys()), list(tail.values())))
            yield pd.DataFrame(rows, columns=["id", "held_out", "n_tokens", "known", "base", "model", "words", "times"]).astype(
                {"id": object})

    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    source = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), F.col(text_col).alias("text"))
    scored = materialise(source.mapInPandas(
        score, f"id {kind}, held_out boolean, n_tokens long, known long, base double, model double, words array<binary>, "
               "times array<int>").withColumn("row", F.monotonically_increasing_id()), "lm-scored")

    class_log = F.element_at(F.array(*[F.lit(float(x)) for x in vocabulary.class_log]), _class_column(F.col("word")) + 1)
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("z")).select(
        "row", F.col("z.words").alias("word"), F.col("z.times").alias("times"))
    log = F.log10(F.coalesce(F.col("n"), F.lit(0)) + 1.0)
    rest = (rare.join(counts, "word", "left")
            .select("row", F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"),
                    (F.col("times") * log).alias("base"), (F.col("times") * (log - class_log)).alias("model"))
            .groupBy("row").agg(F.sum("known").alias("r_known"), F.sum("base").alias("r_base"), F.sum("model").alias("r_model"))
            .withColumnRenamed("row", "r_row"))
    joined = scored.drop("words", "times").join(rest, F.col("row") == F.col("r_row"), "left")
    zero = F.lit(0.0)
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("r_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", zero) - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        (F.col("model") + F.coalesce("r_model", zero)).alias("score"))
