import collections
import random

import pytest

import corpus_pipeline
from martwright.llm import mixing
from martwright.operators.workspace import cut_lineage


@pytest.fixture(scope="module")
def steps(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], sf)))
    return out


def test_stages_hand_documents_on(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    ids = [sorted(r.doc_id for r in s.select("doc_id").distinct().collect()) for s in steps]
    assert set(ids[2]) <= set(ids[1]) <= set(ids[0]) and ids[2] == ids[3] == ids[4] == ids[5]


def test_clean_documents_stay(spark, steps):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kept = {r.doc_id for r in steps[1].collect()}
    long = {r.doc_id for r in steps[0].collect() if len(r.text.split()) >= 50}
    clean = {r.doc_id for r in labels.where("quality = 1").collect()} & long
    assert len(clean & kept) >= 0.95 * len(clean)


def test_sequences_follow_the_mix(spark):
    """A hot source has most of the bytes; prefixes of sequences hold each source by its weight."""
    rnd = random.Random(9)
    words = [f"{rnd.choice('bcdfgkmnprst')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}" for _ in range(200)]
    rows = []
    for i in range(5000):
        source = rnd.choices(["hot", "warm", None], [12, 3, 1])[0]
        rows.append((i, " ".join(rnd.choices(words, k=rnd.randint(100, 600))), "en", source, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    found = corpus_pipeline.packed(spark, docs, "").collect()
    mixed = [(r.source, len(r.text)) for r in mixing.mix(docs).orderBy("slot", "place").collect()]
    of = {r[0]: (r[3], len(r[1])) for r in rows}
    tokens = collections.Counter()
    for r in found:
        tokens[r.doc_id] += r.length
    packed = sorted((r.sequence_id, r.offset, r.doc_id, r.length) for r in found)
    have, total = collections.Counter(), 0
    want, upto, at = collections.Counter(), 0, 0
    far = []
    for n, (sequence, _, doc, length) in enumerate(packed):
        source, size = of[doc]
        have[source] += size * length / tokens[doc]
        total += size * length / tokens[doc]
        while at < len(mixed) and upto + mixed[at][1] <= total:
            want[mixed[at][0]] += mixed[at][1]
            upto += mixed[at][1]
            at += 1
        if n + 1 == len(packed) or packed[n + 1][0] != sequence:
            far.append(max(abs(have[s] - want[s]) for s in ("hot", "warm", None)))
    sequences = len({x[0] for x in packed})
    print("furthest from the mix, in blocks:", max(far) / 65536, "sequences:", sequences, "of", sum(tokens.values()) / 2048)
    assert max(far) <= 65536
    assert sequences <= 1.01 * sum(tokens.values()) / 2048 + 1
