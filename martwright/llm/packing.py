"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A document's ids end with one separator. Documents longer than a sequence are cut into whole
sequences, with the shorter piece first; whole pieces need no packing. The other pieces are dealt to
districts of about ``district`` pieces, by hash or, where an order is given, by ranges of it, and every
district is evolved on several islands:

* An individual is a packing, a list of bins. The first ones come from best fit over shuffled and
  over falling lengths. Fitness is the number of bins, then the mean square of their fill.
* Crossover injects the best-filled whole bins of one parent into the other, removes the bins that
  hold a document twice, and best-fits the displaced documents again.
* After an epoch the islands of a district meet: the elite of each migrates to the others, a second
  epoch crosses them, and the best packing stays.

Bins that are filled to ``closed`` are then final; the documents of the others are dealt again, to
districts of about ``merge`` times as many pieces, so the space that is lost to division shrinks with
every level. Districts never grow beyond that, whatever stays open. Where a level saves less than
one open bin in ``gain``, lengths do not fit better than that: its bins are final too, but for those
filled to half or less, which other districts' may still join. Best fit leaves about one of these in
a district, so few documents go on and the levels end. Only lengths and numbers are shuffled, never
ids or texts.

With an order, sequences are numbered along it: by the mean place of their pieces, whole pieces
included. As pieces that go on meet others from far away, only bins filled to half or less do so then.

Defined results: null and empty texts are the separator alone; null keys pack like others; repeated
rows are packed once each; an empty table has no sequences. Ids are those of ``tokens``.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm import tokens
from martwright.operators.workspace import cut_lineage

SEQUENCE = 2048
SEPARATOR = 0


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SEQUENCE, along: tuple[str, ...] = ()
) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32), and the columns ``along`` of the document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for r, x in enumerate(batch.column(1)):
                ids = np.append(tokens.encode_long(x.as_py() or "").astype("<u4"), np.array([SEPARATOR], "<u4"))
                first = len(ids) % size or size
                for n, end in enumerate(range(first, len(ids) + 1, size)):
                    begin = max(0, end - size) if n else 0
                    row.append(r)
                    piece.append(n)
                    start.append(begin)
                    length.append(end - begin)
                    crc.append(zlib.crc32(ids[begin:end].tobytes()))
            rows = pa.array(row, pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(rows),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    *(c.take(rows) for c in batch.columns[2:]),
                ],
                ["key", "piece", "start", "length", "ids_crc32", *along],
            )

    kind = docs.schema[key].dataType.simpleString()
    more = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in along)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *along).mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long{more}"
    )


class Bins:
    """Open bins by free space; ``fit`` takes the bin that an item fills best."""

    def __init__(self, size: int):
        self.size, self.bins, self.free, self.open, self.by_free = size, [], [], 0, [[] for _ in range(size + 1)]

    def add(self, items: list[int], fill: int) -> None:
        self.bins.append(items)
        self.free.append(self.size - fill)
        self._file(len(self.bins) - 1)

    def _file(self, b: int) -> None:
        free = self.free[b]
        if free:
            self.by_free[free].append(b)
            self.open |= 1 << free

    def fit(self, item: int, length: int) -> None:
        wide = self.open >> length
        if not wide:
            self.add([item], length)
            return
        free = length + (wide & -wide).bit_length() - 1
        held = self.by_free[free]
        b = held.pop()
        if not held:
            self.open ^= 1 << free
        self.bins[b].append(item)
        self.free[b] = free - length
        self._file(b)


def best_fit(order: list[int], lengths: list[int], size: int, kept: list[list[int]] = ()) -> list[list[int]]:
    packing = Bins(size)
    for b in kept:
        packing.add(b, sum(lengths[i] for i in b))
    for i in order:
        packing.fit(i, lengths[i])
    return packing.bins


def fitness(packing: list[list[int]], lengths: list[int]) -> tuple[int, int]:
    return len(packing), -sum(sum(lengths[i] for i in b) ** 2 for b in packing)


def crossover(
    one: list[list[int]], other: list[list[int]], lengths: list[int], size: int, rnd: random.Random
) -> list[list[int]]:
    """``one`` with some of the best-filled bins of ``other`` put in whole."""
    fills = [sum(lengths[i] for i in b) for b in other]
    ranked = sorted(range(len(other)), key=lambda b: (-fills[b], b))
    top = ranked[: max(1, len(ranked) // 2)]
    chosen = [other[b] for b in rnd.sample(top, max(1, len(top) // 4))]
    injected = {i for b in chosen for i in b}
    kept, displaced = [list(b) for b in chosen], []
    # The emptiest bin of the first parent gives its documents up as well.
    worst = min(range(len(one)), key=lambda b: sum(lengths[i] for i in one[b]))
    for n, b in enumerate(one):
        if n == worst or not injected.isdisjoint(b):
            displaced += [i for i in b if i not in injected]
        else:
            kept.append(list(b))
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, size, kept)


def evolve(
    population: list[list[list[int]]], lengths: list[int], size: int, rounds: int, rnd: random.Random
) -> list[list[list[int]]]:
    """The population after some crossovers, best first; stops at the least number of bins there can be."""
    least = -(-sum(lengths) // size)
    rank = lambda p: fitness(p, lengths)
    population = sorted(population, key=rank)
    for _ in range(rounds):
        if len(population[0]) == least:
            break
        a, b = rnd.sample(range(len(population)), 2) if len(population) > 1 else (0, 0)
        child = crossover(population[a], population[b], lengths, size, rnd)
        population = sorted([*population, child], key=rank)[: max(2, len(population))]
    return population


def first_epoch(lengths: list[int], size: int, island: int, people: int, rounds: int) -> list[list[int]]:
    rnd = random.Random(island + 1)
    falling = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    population = [best_fit(falling, lengths, size)]
    if len(population[0]) == -(-sum(lengths) // size):
        return population[0]
    for _ in range(people - 1):
        # Falling order with neighbours shaken, so that other fits are tried.
        shaken = sorted(range(len(lengths)), key=lambda i: -lengths[i] * rnd.uniform(0.8, 1.0))
        population.append(best_fit(shaken, lengths, size))
    return evolve(population, lengths, size, rounds, rnd)[0]


def _as_bins(numbers: np.ndarray) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(numbers.tolist()):
        bins.setdefault(b, []).append(i)
    return list(bins.values())


def _numbers(packing: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int64)
    for b, items in enumerate(packing):
        out[items] = b
    return out


def _level(items: DataFrame, size: int, islands: int, people: int, rounds: int) -> DataFrame:
    """``items`` (item, length, district) with bin, offset and fill; a bin is (district, bin)."""

    def island(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        number = table.column("island")[0].as_py()
        packing = first_epoch(table.column("length").to_pylist(), size, number, people, rounds)
        return table.append_column("bin", pa.array(_numbers(packing, len(table)), pa.int64()))

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("island", "ascending"), ("item", "ascending")])
        which = table.column("island").to_numpy()
        elites = [table.filter(pa.array(which == i)) for i in np.unique(which)]
        home = elites[0]
        lengths = home.column("length").to_pylist()
        population = [_as_bins(e.column("bin").to_numpy()) for e in elites]
        packing = evolve(population, lengths, size, rounds, random.Random(0))[0]
        offset = np.zeros(len(lengths), np.int64)
        fill = np.zeros(len(lengths), np.int64)
        for b in packing:
            at = 0
            for i in b:
                offset[i], at = at, at + lengths[i]
            fill[b] = at
        out = home.select(["item", "length", "district"])
        out = out.append_column("bin", pa.array(_numbers(packing, len(lengths)), pa.int64()))
        return out.append_column("offset", pa.array(offset)).append_column("fill", pa.array(fill))

    dealt = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    evolved = dealt.groupBy("district", "island").applyInArrow(
        island, "item long, length long, district long, island int, bin long"
    )
    return evolved.groupBy("district").applyInArrow(
        meet, "item long, length long, district long, bin long, offset long, fill long"
    )


def ranked(df: DataFrame, number: str, *order: str) -> DataFrame:
    """``df``, stored in the given order, with the rows' numbers from 0."""
    low = (1 << 33) - 1
    stored = cut_lineage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = stored.withColumn("_part", part).join(starts, "_part")
    return numbered.withColumn(number, F.col("_start") + F.col("_at").bitwiseAND(F.lit(low))).drop("_at", "_part", "_start")


def pack(
    cut: DataFrame,
    size: int = SEQUENCE,
    district: int = 2000,
    merge: int = 16,
    islands: int = 2,
    people: int = 3,
    rounds: int = 6,
    closed: float = 0.998,
    gain: int = 1000,
    along: tuple[str, ...] = (),
) -> DataFrame:
    """``cut`` (a column ``length`` of 1 to ``size``) with sequence_id and offset.

    The rows are written once to the shared folder and numbered there. Districts are dealt and
    sequences numbered in the order of the columns ``along``, if they are given.
    """
    # A number per row, unique and, as the rows are stored with it, fixed.
    if along:
        numbered = cut_lineage(ranked(cut, "item", *along))
    else:
        numbered = cut_lineage(cut.withColumn("item", F.monotonically_increasing_id()))
    placed = numbered.where(F.col("length") >= size).select(
        "item", F.lit(0).cast("long").alias("level"), F.col("item").alias("district"), F.lit(0).cast("long").alias("bin"),
        F.lit(0).cast("long").alias("offset"),
    )
    pending = numbered.where(F.col("length") < size).select("item", "length")
    left, bins, tails, level = pending.count(), None, bool(along), 1
    while True:
        held = district if level == 1 else district * merge
        districts = max(1, -(-left // held))
        if along and districts > 1:
            dealt = ranked(pending, "_rank", "item").withColumn("district", F.expr(f"_rank DIV {held}")).drop("_rank")
        else:
            dealt = pending.withColumn("district", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(districts)))
        packed = cut_lineage(_level(dealt, size, islands, people, rounds))
        # Every bin has one row at offset 0.
        is_open, half = F.col("fill") < closed * size, F.col("fill") <= size // 2
        count = lambda what: F.coalesce(F.sum(what.cast("long")), F.lit(0))
        first = F.col("offset") == 0
        made, opened, going, halves = packed.agg(
            count(first), count(first & is_open), count(is_open), count(half)
        ).first()
        tails = tails or (bins is not None and (bins - made) * gain < bins)
        # Of one district, or of tails that no longer get fewer, nothing goes on.
        last = districts == 1 or (tails and 2 * halves > left)
        on = F.lit(False) if last else half if tails else is_open
        placed = placed.unionByName(
            packed.where(~on).select("item", F.lit(level).cast("long").alias("level"), "district", "bin", "offset")
        )
        left, bins = (halves, None) if tails else (going, opened)
        if last or not left:
            break
        pending = packed.where(on).select("item", "length")
        level += 1
    if along:
        places = cut_lineage(placed)
        middle = places.groupBy("level", "district", "bin").agg(F.avg("item").alias("_middle"))
        named = ranked(middle, "sequence_id", "_middle", "level", "district", "bin")
        placed = places.join(named, ["level", "district", "bin"]).drop("_middle")
    else:
        # level, district and bin in one number: whole pieces keep their own, even, number.
        number = F.when(F.col("level") == 0, 2 * F.col("item")).otherwise(
            2 * (F.col("level") * (1 << 54) + F.col("district") * (1 << 24) + F.col("bin")) + 1
        )
        placed = placed.withColumn("sequence_id", number)
    return numbered.join(placed, "item").drop("item", "level", "district", "bin")
