"""SimHash near-duplicates, found with pivot distance tables.

A text's fingerprint has 64 bits: a bit is set if it is set in over half of the XXH64 hashes of the
text's word shingles. Two fingerprints are linked if they differ in at most ``max_bits`` bits; the
classes of the links' transitive closure get the smallest document id as their name.

Equal fingerprints are one node. The table of a fingerprint's Hamming distances to reference
fingerprints (pivots) bounds its distance to any other from below: by the triangle inequality two
fingerprints within ``max_bits`` differ by at most that much in every coordinate. Two sorts of
pivots are used:

* The zero fingerprint and the fingerprints of one bit tell the bits themselves (d(x, 0) - d(x, e) is
  1 or -1), and those of disjoint blocks add up: the coordinate differences of all blocks together
  are at most ``max_bits``, so of ``BLOCKS`` blocks all but ``max_bits`` agree in every such
  coordinate. Each choice of the agreeing blocks is one key; only fingerprints that agree on a key
  meet. No pair is lost.
* Inside a key, 16 pseudo-random pivots are tabled. Candidates come from a range of the first
  coordinate, are discarded by the largest coordinate difference, and survivors are verified by
  counting their differing bits.

Within a key only a spanning forest of its links is emitted, never all pairs. A key of more than
``CELL`` fingerprints is dealt in chunks, and every two chunks meet in a cell of their own. The
forests' edges are joined to classes by union-find inside tasks and by large-star and small-star steps
between them, kept in the shared folder.

Defined results: null and empty texts have fingerprint zero, linked like any other; null keys take
part in fingerprints and classes but never name one (a class of null keys only has a null name);
repeated rows fall into one class; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

SEED = 42
BLOCKS = 6
CELL = 4096
#: Edges that one task joins to classes (dictionaries of some 100 MB).
TASK_EDGES = 500_000
PIVOTS = np.random.default_rng(20).integers(0, 2**64, 16, dtype=np.uint64)


def fingerprint(text: str, shingle: int = 3) -> int:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        hashes = [hash_of(b" ".join(words), SEED)]
    else:
        hashes = [hash_of(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)), strict=False)]
    counts = np.zeros(64, np.int64)
    every = np.array(hashes, "<u8")
    for at in range(0, n, 8192):
        part = every[at : at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """Rows (key, fp): the fingerprint as a signed number."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py() or "", shingle) for x in batch.column(1)]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(values)], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(make, f"key {kind}, fp long")


def masks(max_bits: int = 3, blocks: int = BLOCKS) -> list[int]:
    """For each choice of ``blocks - max_bits`` agreeing blocks, the mask of their bits (signed)."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    chosen = [sum(c) for c in itertools.combinations(block, blocks - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints (places in ``fps``)."""
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table, first = fps[order], table[order], table[order, 0]
    left = np.ones(len(fps), bool)
    edges = []
    for root in range(len(fps)):
        if not left[root]:
            continue
        left[root] = False
        reach = [root]
        while reach:
            x = reach.pop()
            low, high = np.searchsorted(first, [first[x] - max_bits, first[x] + max_bits + 1])
            near = low + np.flatnonzero(left[low:high])
            if len(near):
                near = near[np.abs(table[near] - table[x]).max(axis=1) <= max_bits]
                near = near[np.bitwise_count(fps[near] ^ fps[x]) <= max_bits]
                left[near] = False
                reach += near.tolist()
                edges += [(int(order[x]), int(order[y])) for y in near]
    return edges


def links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (u, v) whose closure is that of all links among ``nodes`` (distinct fp, node)."""
    choices = masks(max_bits)
    keys = [F.struct(F.lit(j).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for j, m in enumerate(choices)]
    keyed = nodes.select("fp", "node", F.inline(F.array(*keys)))
    counts = keyed.groupBy("choice", "part").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CELL).cast("int")
    met = (
        keyed.join(counts, ["choice", "part"])
        .withColumn("_chunks", chunks)
        .withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_chunks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .select("choice", "part", F.least("_own", "_other").alias("a"), F.greatest("_own", "_other").alias("b"), "fp", "node")
    )
    dealt = met.repartition("choice", "part", "a", "b").sortWithinPartitions("choice", "part", "a", "b")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(cell: list[np.ndarray]) -> pa.RecordBatch:
            bounds = np.flatnonzero((cell[0][:, 1:] != cell[0][:, :-1]).any(axis=0)) + 1
            fps, node = cell[1].view(np.uint64), cell[2]
            us, vs = [], []
            for lo, hi in itertools.pairwise([0, *bounds.tolist(), cell[0].shape[1]]):
                if hi - lo == 2:
                    if np.bitwise_count(fps[lo] ^ fps[lo + 1]) <= max_bits:
                        us.append(node[lo])
                        vs.append(node[lo + 1])
                elif hi - lo > 2:
                    for x, y in forest(fps[lo:hi], max_bits):
                        us.append(node[lo + x])
                        vs.append(node[lo + y])
            return pa.record_batch([pa.array(np.array(us, np.int64)), pa.array(np.array(vs, np.int64))], ["u", "v"])

        held: list[np.ndarray] | None = None  # the rows of the last cell, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            rows = [np.stack([c.astype(np.int64) for c in columns[:4]]), columns[4], columns[5]]
            if held is not None:
                rows = [np.concatenate([h, r], axis=-1) for h, r in zip(held, rows, strict=True)]
            same = (rows[0] == rows[0][:, -1:]).all(axis=0)
            start = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if start:
                yield edges([r[..., :start] for r in rows])
            held = [r[..., start:] for r in rows]
        if held is not None:
            yield edges(held)

    return dealt.mapInArrow(meet, "u long, v long").where("u != v").distinct()


def contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """Edges (u, v), u > v, with the same classes: each of ``tasks`` tasks links its nodes to their smallest."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while above.get(top, top) != top:
                top = above[top]
            while above.get(x, x) != top:
                above[x], x = top, above.get(x, x)
            return top

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(u), root(v)
                if x != y:
                    above[max(x, y)] = min(x, y)
        nodes = list(above)
        roots = [root(x) for x in nodes]
        for at in range(0, len(nodes), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.record_batch([pa.array(nodes[part], pa.int64()), pa.array(roots[part], pa.int64())], ["u", "v"])

    return edges.select("u", "v").coalesce(tasks).mapInArrow(contract, "u long, v long").where("u != v")


def classes(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of every node that has an edge; the component is its smallest node.

    Each task first links the nodes of its edges to the smallest that it knows them to be joined to;
    that is done again after each round of stars. Tasks take ``TASK_EDGES`` edges, so that edges which
    fit one task need no round.
    """
    one = lambda df: df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    state = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    edges = cut_lineage(edges)
    seen, tasks = None, -(-edges.count() // TASK_EDGES)
    while tasks > 1:
        edges = cut_lineage(contracted(edges, tasks).distinct())
        now = state(edges)
        if now == seen:
            break
        seen, tasks = now, -(-now[0] // TASK_EDGES)
        if tasks <= 1:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: every larger neighbour of u moves to u's smallest neighbour.
        large = cut_lineage(one(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: the smaller neighbours of u, and u, move to the smallest of them.
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(one(small.unionByName(low.select("u", F.col("m").alias("v")))))
    if tasks <= 1:
        edges = cut_lineage(contracted(edges, 1))
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    names = edges.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
    return roots.unionByName(names).groupBy("u").agg(F.min("component").alias("component")).withColumnRenamed("u", "node")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """Rows (key, fingerprint, component_id), one per row of ``docs``. The key is a whole number."""
    marked = cut_lineage(fingerprints(docs, key, text, shingle))
    named = cut_lineage(marked.groupBy("fp").agg(F.min("key").cast("long").alias("name")))
    # A fingerprint is its own node: one that no row with a key has links others all the same.
    nodes = named.select("fp", F.col("fp").alias("node"))
    found = cut_lineage(classes(links(nodes, max_bits)))
    grouped = named.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = grouped.groupBy("component").agg(F.min("name").alias("component_id"))
    named = grouped.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        F.col("key").alias(key), _hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_copies(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One document of each class: the one that names it. Rows without a key stay."""
    first = found.where(F.col(key) == F.col("component_id")).select(key).distinct()
    kept = docs.join(first, key, "left_semi").dropDuplicates([key])
    return kept.unionByName(docs.where(F.col(key).isNull()))
