"""Phrases whose words come together more often than chance: counted by prefix-free parsing.

A text is split into pieces and these into words. Words whose hash falls into one of ``EVERY`` classes
are triggers: each starts a new chunk of its piece, which reaches two words into the next chunk. Where a
word starts a chunk depends on that word alone, so equal passages fall into equal chunks wherever they
stand, and a chunk of longer texts occurs once in the dictionary with its frequency in the parse. N-grams
are counted inside the different chunks, weighted by their frequencies. The two words of overlap hold the
ends of phrases that start before them; phrases that start in the overlap belong to the next chunk, so
that each occurrence is counted once.

Phrases of two words are counted only if both words are frequent enough, those of three if both pairs
are. A bit map of the hashes of the frequent ones tells: equal hashes let a phrase pass that is dropped
later by its own count, so the map's bounded size costs time and no result. It is the only thing that
goes through the driver.

Everything is per language. Defined results: null texts have no words; a null language is ``und``;
repeated rows count as often as they occur; ties of the score go by count, then by phrase in byte order;
no documents or no frequent phrase give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

BREAKS = rb"[.,;:!?\x0A-\x0D]"
WORDS = 3
#: One of so many different words starts a chunk.
EVERY = 64
#: Bytes of chunks that a task handles at once, and words whose class it remembers.
GATHERED, REMEMBERED = 1 << 23, 1 << 19
#: Bits of the map of frequent phrases: 64 for each of them, between these bounds (16 MiB).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
SEED = 42
#: Bits by which the hash of a phrase is rotated when a word follows.
TURN = 21


class Triggers(dict):
    """Whether a word starts a chunk, remembered for words met before."""

    def __missing__(self, word: bytes) -> bool:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word) % EVERY == 0
        return found


def chunks(words: list[bytes], triggers: Triggers) -> Iterator[tuple[bytes, int]]:
    """(chunk, words that start in it) of a piece."""
    cuts = [i for i, word in enumerate(words) if triggers[word]]
    if not cuts or cuts == [0]:
        yield b" ".join(words), len(words)
        return
    cuts = [*([0] if cuts[0] else []), *cuts, len(words)]
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield b" ".join(words[low : high + WORDS - 1]), high - low


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (lang, chunk, own, freq): the different chunks, the words that start in each, its frequency."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        breaks = re.compile(BREAKS)
        triggers = Triggers()
        languages, found, own, size = [], [], [], 0

        def rows() -> pa.RecordBatch:
            bodies = pa.array(found, pa.binary()).cast(pa.string())
            return pa.record_batch([pa.array(languages, pa.string()), bodies, pa.array(own, pa.int32())], ["lang", "chunk", "own"])

        for batch in batches:
            for language, body in zip(batch.column(0), batch.column(1), strict=True):
                language, body = language.as_py(), (body.as_py() or "").encode().lower()
                for piece in breaks.split(body):
                    # What is left of white space in a piece are blanks and tabs.
                    words = piece.split()
                    if words:
                        for chunk, starts in chunks(words, triggers):
                            found.append(chunk)
                            own.append(starts)
                languages += [language] * (len(found) - len(languages))
                size += len(body)
                if size >= GATHERED and found:
                    yield rows()
                    languages, found, own, size = [], [], [], 0
        if found:
            yield rows()

    parsed = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")), F.col(text).cast("string")).mapInArrow(
        parse, "lang string, chunk string, own int"
    )
    return parsed.groupBy("lang", "chunk", "own").agg(F.count("*").alias("freq"))


def _hashes(names: pa.Array, words: pa.Array) -> np.ndarray:
    """The hash of each word of a language, as :func:`bit_map` has it."""
    import xxhash

    hash_of = xxhash.xxh64_intdigest
    keys = pc.binary_join_element_wise(names, words, "\n").cast(pa.binary()).to_pylist()
    return np.fromiter((hash_of(k, SEED) for k in keys), np.uint64, len(keys))


def _chained(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of phrases that go on by a word: the old hash rotated, and that of the word."""
    return (phrase << np.uint64(TURN) | phrase >> np.uint64(64 - TURN)) ^ word


def _met(hashed: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    """Which hashes the bit map has."""
    at = (hashed & np.uint64(bits - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def weighted(entries: pa.Table, size: int, maps: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Counts (lang, phrase, f) of the phrases of ``size`` words in dictionary entries.

    ``maps`` has the frequent phrases of one word, two and so on; phrases grow word by word, and only
    where the two shorter ones that they consist of are in the map. Until they are counted they are
    numbers: those of their words, and a hash.
    """
    entries = entries.combine_chunks()
    languages = entries["lang"].combine_chunks().dictionary_encode()
    lists = pc.split_pattern(entries["chunk"].combine_chunks(), " ")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(row)) - (np.cumsum(lengths) - lengths)[row]
    left = lengths[row] - place
    different = len(tokens.dictionary)
    keys = languages.indices.to_numpy().astype(np.int64)[row] * different + tokens.indices.to_numpy()
    unique, word = np.unique(keys, return_inverse=True)
    names = languages.dictionary.take(pa.array(unique // different))
    words = tokens.dictionary.take(pa.array(unique % different))
    parts = [np.arange(len(words))]
    of_words = hashed = _hashes(names, words) if size > 1 else None
    index, valid = word, np.ones(len(row), bool)
    for shorter, (bits, table) in enumerate(maps[: size - 1], 1):
        good = np.zeros(len(row), bool)
        good[valid] = _met(hashed, bits, table)[index[valid]]
        at = np.flatnonzero(good[:-1] & good[1:] & (left[:-1] > shorter))
        unique, found = np.unique(index[at] * len(words) + word[at + shorter], return_inverse=True)
        begin, end = np.divmod(unique, max(len(words), 1))
        parts = [*(part[begin] for part in parts), end]
        hashed = _chained(hashed[begin], of_words[end])
        index, valid = np.zeros(len(row), np.int64), np.zeros(len(row), bool)
        index[at], valid[at] = found, True
    at = np.flatnonzero(valid & (place < entries["own"].to_numpy()[row]))
    counts = np.bincount(index[at], entries["freq"].to_numpy()[row[at]], len(parts[0])).astype(np.int64)
    some = np.flatnonzero(counts)
    phrases = pc.binary_join_element_wise(*(words.take(pa.array(part[some])) for part in parts), " ")
    return pa.record_batch([names.take(pa.array(parts[0][some])), phrases, pa.array(counts[some])], ["lang", "phrase", "f"])


def grams(entries: DataFrame, size: int, maps: list[tuple[int, Broadcast]]) -> DataFrame:
    """Rows (lang, phrase, f): weighted counts of the phrases of ``size`` words.

    ``maps`` has a bit map of the frequent phrases of each smaller size and the number of its bits.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(bits, np.frombuffer(table.value, np.uint8)) for bits, table in maps]
        held, bytes_held = [], 0
        for batch in batches:
            held.append(batch)
            bytes_held += batch.nbytes
            if bytes_held >= GATHERED:
                yield weighted(pa.Table.from_batches(held), size, known)
                held, bytes_held = [], 0
        if bytes_held:
            yield weighted(pa.Table.from_batches(held), size, known)

    counted = entries.select("lang", "chunk", "own", "freq").mapInArrow(count, "lang string, phrase string, f long")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bit_map(frequent: DataFrame) -> tuple[int, bytes]:
    """(number of bits, bits) of the hashes of phrases, chained from those of their words; at most ``MOST_BITS`` whatever their number."""
    bits = LEAST_BITS
    wanted = min(64 * frequent.count(), MOST_BITS)
    while bits < wanted:
        bits *= 2
    of_words = F.transform(F.split("phrase", " "), lambda word: F.xxhash64(F.concat("lang", F.lit("\n"), word)))
    turned = lambda h: F.shiftleft(h, TURN).bitwiseOR(F.shiftrightunsigned(h, 64 - TURN))
    hashed = F.aggregate(of_words, F.lit(0).cast("long"), lambda h, word: turned(h).bitwiseXOR(word))
    place = hashed.bitwiseAND(F.lit(bits - 1))
    # Spark counts the places of its bit maps from one, in buckets of 32768.
    maps = (
        frequent.select((place + 1).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("map"))
    )
    found = bytearray(bits // 8)
    for row in maps.collect():
        found[(row.bucket - 1) * 4096 : row.bucket * 4096] = row.map
    return bits, bytes(found)


def _exact(column: str, digits: int) -> Column:
    return F.col(column).cast(f"decimal({digits},0)")


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, f) with a, l, r and score of their worst cut."""
    words = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(words, F.lit(1), k), " ").alias("first"),
            F.array_join(F.slice(words, k + 1, F.size(words) - k), " ").alias("rest"),
        ),
    )
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), F.inline(cuts))
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    met = cut.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    # a <= l, r: scores fit 64 bits, the products 38 digits for counts of up to 16.
    above = (F.lit(1000000).cast("decimal(7,0)") * (_exact("a", 16) * _exact("a", 16))).cast("decimal(38,0)")
    below = (_exact("l", 16) * _exact("r", 16)).cast("decimal(32,0)")
    whole = met.withColumn("_above", above).withColumn("_below", below)
    worst = F.struct(F.expr("_above div _below").alias("score"), "k", "a", "l", "r")
    return whole.groupBy("lang", "phrase").agg(F.min(worst).alias("worst")).select("lang", "phrase", "worst.*")


def contained(candidates: DataFrame) -> DataFrame:
    """Rows (lang, phrase, longer): the greatest count of a candidate that holds the phrase."""
    words = F.split("phrase", " ")
    inner = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.array_join(F.slice(words, k, 2), " "))
    return (
        candidates.where(F.size(words) > 2)
        .select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 10,
    inside: int = 50,
    best: int = 2000,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of every language.

    Candidates have two or three words and occur ``least`` times. One of which ``inside`` per cent of
    the occurrences, or more, lie in a longer candidate is dropped.
    """
    context = docs.sparkSession.sparkContext
    entries = cut_lineage(dictionary(docs, text, lang))
    words = cut_lineage(grams(entries, 1, []))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    levels, maps = [], []
    for size in range(2, WORDS + 1):
        bits, table = bit_map(frequent)
        maps.append((bits, context.broadcast(table)))
        frequent = cut_lineage(grams(entries, size, maps).where(F.col("f") >= least))
        levels.append(frequent)
    candidates = levels[0].unionByName(levels[1])
    counts = words.where(F.col("f") >= least).unionByName(levels[0])
    dropped = contained(candidates)
    left = (
        scored(candidates, counts)
        .join(dropped, ["lang", "phrase"], "left")
        .where(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True)))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
