import random

import numpy as np
import xxhash

from martwright.llm import simhash


def plain_fingerprint(text, shingle=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    made = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, max_bits):
    """{key: component} by comparing every pair."""
    name = {k: k for k, _ in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints:
            for b, y in prints:
                if (x ^ y).bit_count() <= max_bits and name[b] < name[a]:
                    name[a], changed = name[b], True
    return name


def test_fingerprints(texts):
    for text in [*texts[:40], "", "one", "One TWO", "É É é", "a\x0bb\x1cc d", " x y z"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_classes_of_documents(odd_docs, no_docs):
    rows = odd_docs.where("doc_id IS NOT NULL").select("doc_id", "text").distinct().collect()
    prints = [(r.doc_id, plain_fingerprint(r.text or "")) for r in rows]
    want = plain_classes(prints, 3)
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    assert {(r.doc_id, r.fingerprint) for r in found if r.doc_id is not None} == {(k, f"{x:016x}") for k, x in prints}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_no_link_is_lost(spark, monkeypatch):
    """Chains and dense groups, in cells so small that keys are dealt in chunks."""
    monkeypatch.setattr(simhash, "CELL", 8)
    rnd = random.Random(2)
    prints = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(25):
            prints.add(x)
            y = x
            for _ in range(rnd.randint(1, 5)):
                y ^= 1 << rnd.randrange(64)
            x = rnd.choice([x, y])
    prints = [(i * 3, p) for i, p in enumerate(sorted(prints))]
    signed = [(int(np.uint64(p).astype(np.int64)), i) for i, p in prints]
    nodes = spark.createDataFrame(signed, "fp long, node long")
    found = {r.node: r.component for r in simhash.classes(simhash.links(nodes)).collect()}
    want = plain_classes(prints, 3)
    assert {i: found.get(i, i) for i, _ in prints} == want


def test_one_of_each_class_stays(odd_docs):
    kept = simhash.drop_copies(odd_docs, simhash.near_duplicates(odd_docs))
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(204) == 1 and ids.count(None) == 1
    assert not set(range(100, 110)) & set(ids)


def test_rows_without_id_link_others(spark):
    """A fingerprint that only rows without an id have is linked, and links two others."""
    rnd = random.Random(8)
    x = rnd.getrandbits(64)
    prints = {5: x, None: x ^ 0b111, 9: x ^ 0b111 ^ (0b111 << 20), 4: rnd.getrandbits(64)}
    rows = [(k, str(v)) for k, v in prints.items()] + [(None, str(rnd.getrandbits(64)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = docs.selectExpr("doc_id AS key", "CAST(CAST(text AS DECIMAL(20, 0)) - CASE WHEN CAST(text AS DECIMAL(20, 0)) >= 9223372036854775808"
                             " THEN 18446744073709551616 ELSE 0 END AS BIGINT) AS fp")
    real = simhash.fingerprints
    simhash.fingerprints = lambda *_: marked
    try:
        found = simhash.near_duplicates(docs).collect()
    finally:
        simhash.fingerprints = real
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 5), (4, 4), (5, 5), (9, 5)]


def test_edges_of_several_tasks(spark, monkeypatch):
    """Long chains and stars whose edges do not fit one task."""
    monkeypatch.setattr(simhash, "TASK_EDGES", 40)
    rnd = random.Random(6)
    names = rnd.sample(range(10**6), 300)
    edges = [(names[i], names[i + 1]) for i in range(120)] + [(names[150], names[i]) for i in range(151, 250)]
    edges += [(names[i], names[i + 1]) for i in range(260, 290, 2)] + edges[:30]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(7)
    found = {r.node: r.component for r in simhash.classes(frame).collect()}
    want = {n: min(names[:121]) for n in names[:121]} | {n: min(names[150:250]) for n in names[150:250]}
    for i in range(260, 290, 2):
        want |= {names[i]: min(names[i : i + 2]), names[i + 1]: min(names[i : i + 2])}
    assert found == want
