"""Toxicity of texts: bags of subword embeddings, averaged into a linear softmax.

A word's bag holds the word and its character n-grams, with marks at both ends, by their hash in a table
of vectors. The vectors of a window of neighbouring words are averaged and go through a linear softmax of
two classes. A text is as toxic as its worst window, so that a few words tell in a long text as in a short
one. A misspelling that no labelled text has shares most of its n-grams' vectors with the right spelling;
n-grams that training never met are left out of the bags.

Vectors and softmax are trained together with numpy, by the gradient of the cross entropy: first through
the average of each text's windows, then through its worst window. Training takes a bounded sample of the
labelled rows, ``TRAIN_ROWS`` of each class, the first in the order of a hash, of at most ``TRAIN_BYTES``
together; a tenth of it chooses the round to keep. As the softmax is linear, a window's score is
the mean of one number for each n-gram: that table is all that scoring needs, and it has a fixed size.

Defined results: null and empty texts have one window without words and get the score of the bias; rows
without a key are scored and never learnt from; repeated rows get equal scores; columns named like the new
ones are replaced; without labels of both classes the score is the share of toxic rows among the labelled
ones, 0 where there is none; an empty table gives no rows.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.workspace import cut_lineage

TRAIN_ROWS = 4000
TRAIN_BYTES = 12 << 20
TABLE = 1 << 18
DIM = 8
GRAMS = (3, 4, 5, 6, 7)
WINDOW, STRIDE = 4, 2
ROUNDS, AVERAGED, RATE, DECAY = 60, 10, 0.15, 1e-4
#: Characters of texts that a task scores at once.
GATHERED = 1 << 22
#: Odd numbers modulo 2 ** 64: the base of the polynomials, its inverse, and a multiplier that spreads them.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPREAD = np.uint64(0xD6E8FEB86659FD93)
SHIFT = np.uint64(64 - 18)
STRIPPED = ".,;:!?\"'()[]{}<>|#*$%&"


def words_of(text: str) -> list[str]:
    """Lower-case words without the marks around them."""
    return [w for w in (x.strip(STRIPPED) for x in text.lower().split()) if w]


def bags(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place, word) of every part of every word: places in the table of the word itself and its n-grams.

    Parts are hashed as polynomials over their characters, all at once by differences of prefix sums.
    """
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(codes)
    powers, inverses = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    powers[1:], inverses[1:] = BASE, INVERSE
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(inverses, out=inverses)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * powers[:-1], out=upto[1:])
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    left = np.repeat(ends, lengths) - np.arange(n)
    at = lambda low, high: (((upto[high] - upto[low]) * inverses[low]) * SPREAD >> SHIFT).astype(np.int32)
    places, owners = [at(ends - lengths, ends)], [np.arange(len(words), dtype=np.int32)]
    for size in GRAMS:
        low = np.flatnonzero(left >= size)
        places.append(at(low, low + size))
        owners.append(word[low])
    return np.concatenate(places), np.concatenate(owners)


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of a text of ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


def _logistic(x):
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


class Texts:
    """Texts as arrays: their words, the words' bags, and windows. Parts not in ``known`` are left out."""

    def __init__(self, texts: Iterable[str], known: np.ndarray | None = None):
        index: dict[str, int] = {}
        tokens, lows, highs, docs = [], [], [], []
        upto = 0
        for d, text in enumerate(texts):
            ids = [index.setdefault(w, len(index)) for w in words_of(text)]
            low = window_starts(len(ids))
            tokens.append(np.array(ids, np.int32))
            lows.append(low + upto)
            highs.append(np.minimum(low + WINDOW, len(ids)) + upto)
            docs.append(np.full(len(low), d, np.int32))
            upto += len(ids)
        self.tokens = np.concatenate(tokens)
        self.low, self.high, self.doc = np.concatenate(lows), np.concatenate(highs), np.concatenate(docs)
        self.first = np.flatnonzero(np.diff(self.doc, prepend=-1))
        self.words = len(index)
        self.parts, self.word = bags(list(index))
        if known is not None:
            met = known[self.parts]
            self.parts, self.word = self.parts[met], self.word[met]
        sizes = self._windows(np.bincount(self.word, minlength=self.words))
        self.sizes = np.maximum(sizes, 1)

    def _windows(self, per_word: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(per_word[self.tokens])])
        return upto[self.high] - upto[self.low]

    def logits(self, numbers: np.ndarray, bias: float) -> np.ndarray:
        """One number for every window: the mean over its parts."""
        return self._windows(np.bincount(self.word, numbers[self.parts], self.words)) / self.sizes + bias

    def worst(self, logits: np.ndarray) -> np.ndarray:
        """The greatest number of every text's windows."""
        return np.maximum.reduceat(logits, self.first)

    def parts_of(self, windows: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """For every place of the table the sum of ``shares`` (one for each of ``windows``) that fall to it."""
        lengths = self.high[windows] - self.low[windows]
        at = np.repeat(self.low[windows] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        per_word = np.bincount(self.tokens[at], np.repeat(shares, lengths), self.words)
        return np.bincount(self.parts, per_word[self.word], TABLE)


@dataclasses.dataclass
class Model:
    """The number of every place of the table (0: never trained), which places count, and the bias."""

    numbers: np.ndarray
    known: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        cut = Texts(texts, self.known)
        return _logistic(cut.worst(cut.logits(self.numbers, self.bias)))


def train(texts: list[str], labels: list[int]) -> Model:
    """The model of a sample that has both labels; every tenth text chooses the round that is kept."""
    rnd = np.random.default_rng(7)
    held = np.arange(len(texts)) % 10 == 9
    pick = lambda values, which: [v for v, w in zip(values, which, strict=True) if w]
    if len(set(pick(labels, ~held))) < 2:
        held[:] = False
    fit, toxic = Texts(pick(texts, ~held)), np.array(pick(labels, ~held), np.float64)
    known = np.zeros(TABLE, bool)
    known[fit.parts] = True
    check, truth = fit, toxic
    if held.any():
        check, truth = Texts(pick(texts, held), known), np.array(pick(labels, held), np.float64)
    vectors = rnd.uniform(-1 / DIM, 1 / DIM, (TABLE, DIM))
    softmax, bias = rnd.normal(0, 1, (2, DIM)), np.zeros(2)
    vectors[~known] = 0
    values = [vectors, softmax, bias]
    slow = [[np.zeros_like(v), np.zeros_like(v)] for v in values]
    best, kept = np.inf, None
    count, share_toxic = len(toxic), toxic.mean()
    weight = np.where(toxic > 0, 0.5 / share_toxic, 0.5 / (1 - share_toxic)) / count
    for turn in range(1, ROUNDS + 1):
        across = softmax[1] - softmax[0]
        found = fit.logits(vectors @ across, bias[1] - bias[0])
        if turn <= AVERAGED:
            # Through all windows of a text, each with its share.
            windows = np.arange(len(found))
            of = np.bincount(fit.doc, minlength=count)
            error = (_logistic(np.bincount(fit.doc, found) / of) - toxic) * weight
            share = (error / of)[fit.doc]
        else:
            top = fit.worst(found)
            windows = np.flatnonzero(found == top[fit.doc])
            windows = windows[np.flatnonzero(np.diff(fit.doc[windows], prepend=-1))]
            error = share = (_logistic(top) - toxic) * weight
        per_place = fit.parts_of(windows, share / fit.sizes[windows])
        hidden = per_place @ vectors
        gradients = [
            np.outer(per_place, across) + DECAY / count * vectors,
            np.stack([-hidden, hidden]) + DECAY * softmax,
            np.array([-error.sum(), error.sum()]),
        ]
        for value, gradient, (one, two) in zip(values, gradients, slow, strict=True):
            one += 0.1 * (gradient - one)
            two += 0.01 * (gradient * gradient - two)
            value -= RATE * (one / (1 - 0.9**turn)) / (np.sqrt(two / (1 - 0.99**turn)) + 1e-9)
        vectors[~known] = 0
        if turn > AVERAGED:
            across = softmax[1] - softmax[0]
            guess = check.worst(check.logits(vectors @ across, bias[1] - bias[0]))
            loss = np.logaddexp(0, np.where(truth > 0, -guess, guess)).mean()
            if loss < best:
                best, kept = loss, Model((vectors @ across).astype(np.float32), known.copy(), float(bias[1] - bias[0]))
    return kept


def sample(
    docs: DataFrame, marks: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES
) -> DataFrame:
    """Rows (key, label, text) of ``docs`` (key, text): the first of each class in the order of a hash.

    They are chosen from keys and lengths alone; only the texts of the sample, ``rows`` of each class and
    together at most ``size`` bytes, leave their place. Of texts of one key and length the least is taken.
    """
    there = docs.groupBy("key", F.octet_length("text").alias("bytes")).agg(F.lit(1).alias("_one")).drop("_one")
    labelled = there.join(marks, "key").withColumn("at", F.xxhash64("key", "bytes"))
    order = ["at", "key", "bytes"]
    first = [labelled.where(F.col("label") == c).orderBy(*order).limit(rows) for c in (0, 1)]
    ranked = first[0].unionByName(first[1]).withColumn(
        "place", F.row_number().over(Window.partitionBy("label").orderBy(*order))
    )
    upto = F.sum("bytes").over(Window.orderBy("place", "label").rowsBetween(Window.unboundedPreceding, 0))
    chosen = ranked.withColumn("upto", upto).where(F.col("upto") <= size).select("key", "bytes", "label")
    # At most twice `rows` narrow rows.
    wanted = F.broadcast(cut_lineage(chosen))
    met = docs.withColumn("bytes", F.octet_length("text")).join(wanted, ["key", "bytes"])
    return met.groupBy("key", "label", "bytes").agg(F.min("text").alias("text")).drop("bytes")


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text") -> Model:
    """The model learnt from the labelled documents for which ``allowed`` (over ``key``) holds."""
    marks = labels.where(allowed).select(F.col(key).alias("key"), F.col("toxic").cast("int").alias("label"))
    body = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = sample(body, marks.where("label IN (0, 1)").distinct()).collect()
    rows.sort(key=lambda r: (hashlib.sha256(str(r.key).encode()).digest(), r.label))
    toxic = sum(r.label for r in rows)
    if 0 < toxic < len(rows):
        return train([r.text for r in rows], [r.label for r in rows])
    share = toxic / len(rows) if rows else 0.0
    with np.errstate(divide="ignore"):
        return Model(np.zeros(TABLE, np.float32), np.zeros(TABLE, bool), float(np.log(share) - np.log1p(-share)))


def scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted."""
    added = T.StructType().add("score", T.DoubleType()).add("predicted", T.IntegerType())
    carried = [c for c in docs.columns if c not in added.fieldNames()]
    kept = T.StructType([docs.schema[c] for c in carried])
    told = docs.sparkSession.sparkContext.broadcast(model)
    inputs = docs.select(F.col(text).cast("string"), *carried)
    inputs = inputs.toDF(*[f"c{i}" for i in range(len(inputs.columns))])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, texts = 0, 0, []
            for at in range(batch.num_rows):
                texts.append(batch.column(0)[at].as_py() or "")
                size += len(texts[-1])
                if size >= GATHERED or at + 1 == batch.num_rows:
                    found = told.value.scores(texts)
                    rows = batch.slice(start, at + 1 - start).columns[1:]
                    predicted = pa.array((found >= 0.5).astype(np.int32))
                    yield pa.record_batch([*rows, pa.array(found), predicted], [*carried, *added.fieldNames()])
                    start, size, texts = at + 1, 0, []

    return inputs.mapInArrow(give, T.StructType([*kept.fields, *added.fields]))


def fold(key: str = "doc_id") -> Column:
    """The remainder by five of the checksum of the key as text; rows of remainder 0 are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5
