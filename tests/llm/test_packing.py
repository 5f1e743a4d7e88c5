import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from martwright.llm import packing


def check(rows, size):
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for b in held.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(held)


def test_pieces_hold_the_ids(odd_docs, no_docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in odd_docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((str(r.doc_id), n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    cut = packing.pieces(odd_docs)
    assert sorted((str(r.key), r.piece, r.start, r.length, r.ids_crc32) for r in cut.collect()) == sorted(want)
    assert packing.pack(packing.pieces(no_docs)).count() == 0


def test_packing_is_tight_and_whole(spark):
    rnd = random.Random(5)
    lengths = [rnd.choice([rnd.randint(1, 2048), rnd.randint(1, 400), 2048]) for _ in range(3000)]
    rows = packing.pack(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long"), district=300, merge=4).collect()
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths))
    assert check(rows, 2048) <= -(-sum(lengths) // 2048) + 2


def test_crossover_keeps_every_document():
    rnd = random.Random(1)
    lengths = [rnd.randint(100, 1500) for _ in range(200)]
    one = packing.best_fit(list(range(200)), lengths, 2048)
    other = packing.best_fit(rnd.sample(range(200), 200), lengths, 2048)
    for _ in range(20):
        child = packing.crossover(one, other, lengths, 2048, rnd)
        assert sorted(i for b in child for i in b) == list(range(200))
        assert max(sum(lengths[i] for i in b) for b in child) <= 2048
        one = child


def test_districts_stay_bounded(spark, monkeypatch):
    """Pieces of which no two fit, and pieces without fillers: nothing closes, yet no group takes them all."""
    sizes, level = [], packing._level

    def spy(*args):
        packed = level(*args).cache()
        sizes.append(max((r["count"] for r in packed.groupBy("district").count().collect()), default=0))
        return packed

    monkeypatch.setattr(packing, "_level", spy)
    rnd = random.Random(7)
    for low, high, spare in [(1025, 2043, 0), (701, 1347, 0.02)]:
        lengths = [rnd.randint(low, high) for _ in range(6000)]
        sizes.clear()
        docs = spark.createDataFrame(list(enumerate(lengths)), "id long, length long")
        rows = packing.pack(docs, district=100, merge=4).collect()
        assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths))
        assert max(sizes) <= 1.4 * 400 and len(sizes) > 1
        best = len(packing.best_fit(sorted(range(6000), key=lambda i: -lengths[i]), lengths, 2048))
        assert check(rows, 2048) <= best * (1 + spare)


def test_sequences_follow_an_order(spark):
    rnd = random.Random(8)
    rows = [(rnd.randint(0, 500), i, rnd.choice([rnd.randint(1, 900), 2048])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "at long, id long, length long").repartition(3)
    found = packing.pack(docs, district=200, along=("at", "id")).collect()
    assert sorted((r.at, r.id, r.length) for r in found) == sorted(rows)
    sequences = check(found, 2048)
    assert {r.sequence_id for r in found} == set(range(sequences))
    whole = [(r.sequence_id, r.at, r.id) for r in found if r.length == 2048]
    assert [x[1:] for x in sorted(whole)] == sorted(x[1:] for x in whole)
    place = {x: n / len(rows) for n, x in enumerate(sorted((a, i) for a, i, _ in rows))}
    off = [abs(r.sequence_id / sequences - place[r.at, r.id]) for r in found]
    assert sum(off) / len(off) < 0.05
