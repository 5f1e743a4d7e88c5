"""One document of each class of near copies: texts whose word shingles are at least 0.8 alike.

The similarity of two texts is that of their sets of five-word shingles, common ones over all
(Jaccard); texts of fewer than five words are one shingle. Texts that are alike are linked, and one
document of each class of the links' transitive closure stays.

At that similarity two 64-bit fingerprints differ in 10 bits on average and in 19 now and then, too
many for block keys or pivots to tell them from strangers. Candidates are found by MinHash instead: a
text has ``BANDS`` keys, each of the least values of ``ROWS`` hash functions over its shingles, and
texts meet if they share a key. A pair that is 0.8 alike is missed with probability
(1 - 0.8 ** 5) ** 32 = 3e-6, a closer one less often.

Texts of equal words are one node. Nodes that share a key are compared as in :mod:`martwright.llm.simhash`:
a SimHash fingerprint, here of ``BITS`` bits over the different shingles, and a table of its distances to
pivots, fingerprints of the cell. The bits of a pair 0.8 alike differ with probability 0.15 (0.19 for texts
of four and five shingles), in more than ``NEAR`` of 256 bits about once in 1e10 pairs, and strangers' in 128 on
average. Two fingerprints that differ by more than ``NEAR`` from some pivot are not compared, by the triangle
inequality; the others by their bits. Unlike texts that share a passage end here. What remains is grouped, and the texts of a group are
sent once and compared by their shingles, so no link is wrong. Neither step emits pairs: both give the
edges of a spanning forest, found by a search in which a node that has been reached is not compared
again. A key or group of more than ``CELL`` nodes is dealt in chunks, and every two chunks meet in a
cell of their own.

Defined results: null and empty texts are copies of each other and of nothing else; rows without a
key take part like others; of a class the smallest key stays, a row without a key only if no row has
one; rows that share a key but not the text are different documents; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.simhash import SEED, classes
from martwright.operators.workspace import cut_lineage

SHINGLE = 5
BANDS, ROWS = 32, 5
#: Bits of a fingerprint, the most in which fingerprints of similar texts differ, pivots of a cell.
BITS, NEAR, PIVOTS = 256, 88, 16
#: Nodes of a chunk, and shingles (32 MB).
CELL, CELL_SHINGLES = 1024, 1 << 22
_rng = np.random.default_rng(20)
FACTORS, TERMS = (_rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
FACTORS |= np.uint64(1)
FOLD = _rng.integers(0, 2**64, ROWS, dtype=np.uint64) | np.uint64(1)
BAND = _rng.integers(0, 2**64, BANDS, dtype=np.uint64)
SPREAD = _rng.integers(0, 2**64, BITS // 64, dtype=np.uint64) | np.uint64(1)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """The hashes of the different shingles, sorted."""
    import xxhash

    hash_of = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([hash_of(b" ".join(words), SEED)] if words else [], np.uint64)
    made = zip(*(words[i:] for i in range(SHINGLE)), strict=False)
    return np.unique(np.array([hash_of(b" ".join(s), SEED) for s in made], np.uint64))


def least_of(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a text's shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * FACTORS + TERMS).min(axis=0), out=least)
    return least


def keys_of(hashes: np.ndarray) -> np.ndarray:
    """The keys of a text's bands; a text without shingles has none."""
    if not len(hashes):
        return np.empty(0, np.int64)
    return _keys(least_of(hashes))


def _keys(least: np.ndarray) -> np.ndarray:
    return ((least.reshape(BANDS, ROWS) * FOLD).sum(axis=1, dtype=np.uint64) ^ BAND).view(np.int64)


def fingerprint_of(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a text's shingles: a bit is 1 if it is set in over half of them."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        # One hash gives four words of bits.
        wide = hashes[at : at + 4096, None] * SPREAD
        wide = (wide ^ (wide >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        wide ^= wide >> np.uint64(32)
        counts += np.unpackbits(wide.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes)).view(np.uint64)


def bits_apart(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many bits the fingerprint x differs from each of the others."""
    return np.bitwise_count(others ^ x).sum(axis=1, dtype=np.int64)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Distances of fingerprints to pivots among them, each the farthest from those before it."""
    table = [bits_apart(prints[0], prints)]
    nearest = table[0]
    while len(table) < PIVOTS and nearest.max() > NEAR:
        table.append(bits_apart(prints[int(nearest.argmax())], prints))
        nearest = np.minimum(nearest, table[-1])
    return np.stack(table, axis=1)


def sketches(docs: DataFrame, row: str, key: str, text: str) -> DataFrame:
    """Rows (row, key, copy, n, parts, sketch): a digest of the words, the number of shingles, the bands' keys, the fingerprint."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            copy, n, parts, sketch = [], [], [], []
            for x in batch.column(2):
                words = words_of(x.as_py() or "")
                hashes = shingles(words)
                least = least_of(hashes)
                copy.append(xxhash.xxh3_128_digest(b" ".join(words)))
                n.append(len(hashes))
                parts.append(_keys(least) if len(hashes) else np.empty(0, np.int64))
                sketch.append(fingerprint_of(hashes).tobytes())
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))
            columns = [batch.column(0), batch.column(1), pa.array(copy, pa.binary()), pa.array(n, pa.int64())]
            columns += [lists, pa.array(sketch, pa.binary())]
            yield pa.record_batch(columns, ["row", "key", "copy", "n", "parts", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(row), F.col(key), F.col(text)).mapInArrow(
        make, f"row long, key {kind}, copy binary, n long, parts array<long>, sketch binary"
    )


def dealt(rows: DataFrame, sizes: DataFrame, by: str, n: str = "n") -> DataFrame:
    """``rows`` with ``a`` and ``b``: the cells that a row belongs to, cells in one place and in order.

    ``sizes`` has the ``nodes`` and ``shingles`` of every value of ``by``.
    """
    chunks = F.ceil(F.greatest(F.col("nodes") / CELL, F.col("shingles") / CELL_SHINGLES)).cast("int")
    cut = (
        rows.join(sizes, by)
        .withColumn("_chunks", F.greatest(chunks, F.lit(1)))
        .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .withColumn("a", F.least("_own", "_other"))
        .withColumn("b", F.greatest("_own", "_other"))
        .select("a", "b", *rows.columns)
    )
    return cut.repartition(by, "a", "b").sortWithinPartitions(by, "a", "b", "node")


def cells(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each cell, sorted by the columns of ``names``, as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        bounds = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:], strict=False):
            key = keys[:, low].tolist()
            if held and key != last:
                yield _one(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def forest(n: int, near) -> list[tuple[int, int]]:
    """Edges of a spanning forest of ``n`` places; ``near(x, others)`` tells which others x is linked to."""
    left = np.arange(n)
    edges = []
    while len(left):
        reach, left = [int(left[0])], left[1:]
        while reach and len(left):
            x = reach.pop()
            linked = near(x, left)
            found, left = left[linked], left[~linked]
            reach += found.tolist()
            edges += [(x, y) for y in found.tolist()]
    return edges


def _edges(node: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], ["u", "v"])


def resembling(met: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges (u, v) among the nodes of a key, rows (part, node, n, sketch), whose fingerprints are near."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in cells(batches, ["part", "a", "b"]):
            if cell.num_rows < 2:
                continue
            n = cell["n"].to_numpy()
            prints = np.frombuffer(b"".join(cell["sketch"].to_pylist()), np.uint64).reshape(len(n), -1)
            table = pivot_table(prints)

            def near(x: int, others: np.ndarray, n=n, prints=prints, table=table) -> np.ndarray:
                fit = 5 * np.minimum(n[x], n[others]) >= 4 * np.maximum(n[x], n[others])
                fit[fit] = np.abs(table[others[fit]] - table[x]).max(axis=1) <= NEAR
                fit[fit] = bits_apart(prints[x], prints[others[fit]]) <= NEAR
                return fit

            found = forest(len(n), near)
            if found:
                yield _edges(cell["node"].to_numpy(), found)

    return dealt(met, sizes, "part").mapInArrow(compare, "u long, v long").distinct()


def alike(texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges (u, v) of a spanning forest of the links within each group, rows (component, node, text)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in cells(batches, ["component", "a", "b"]):
            if cell.num_rows < 2:
                continue
            sets = [shingles(words_of(x.as_py() or "")) for x in cell["text"]]
            n = np.array([len(x) for x in sets])
            ends = np.cumsum(n)
            together = np.concatenate(sets)
            owner = np.repeat(np.arange(len(n)), n)

            def near(x: int, others: np.ndarray, n=n, ends=ends, together=together, owner=owner) -> np.ndarray:
                mine = together[ends[x] - n[x] : ends[x]]
                wanted = np.zeros(len(n), bool)
                wanted[others] = 5 * np.minimum(n[x], n[others]) >= 4 * np.maximum(n[x], n[others])
                which = wanted[owner]
                theirs = together[which]
                hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
                common = np.bincount(owner[which][hit], minlength=len(n))[others]
                return wanted[others] & (5 * common >= 4 * (n[x] + n[others] - common))

            found = forest(len(n), near)
            if found:
                yield _edges(cell["node"].to_numpy(), found)

    return dealt(texts, sizes, "component").mapInArrow(compare, "u long, v long")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the near copies of documents that stay."""
    # A number per row that is fixed, as the rows are stored with it.
    numbered = cut_lineage(docs.withColumn("_row", F.monotonically_increasing_id()))
    marked = cut_lineage(sketches(numbered, "_row", key, text))
    best = F.struct(F.col("key").isNull().alias("lost"), "key", "row")
    nodes = cut_lineage(
        marked.groupBy("copy").agg(F.min(best).alias("best")).select("best", F.col("best.row").alias("node"))
    )
    several = marked.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), "n", "sketch", "parts"
    )
    keyed = cut_lineage(several.select("node", "n", F.explode("parts").alias("part")))
    size = (F.count("*").alias("nodes"), F.sum("n").alias("shingles"))
    shared = cut_lineage(keyed.groupBy("part").agg(F.count("*").alias("nodes"), F.lit(0).alias("shingles")).where("nodes > 1"))
    met = keyed.join(shared.select("part"), "part", "left_semi").join(several.select("node", "sketch"), "node")
    groups = classes(resembling(met, shared))
    found = cut_lineage(several.select("node", "n").join(groups, "node"))
    sizes = cut_lineage(found.groupBy("component").agg(*size))
    texts = numbered.select(F.col("_row").alias("node"), F.col(text).alias("text"))
    links = alike(found.select("component", "node").join(texts, "node"), sizes)
    found = cut_lineage(classes(links))

    kept = (
        nodes.join(found, "node", "left")
        .groupBy(F.coalesce("component", "node"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.row").alias("_row"))
    )
    return numbered.join(kept, "_row", "left_semi").select(*docs.columns)
