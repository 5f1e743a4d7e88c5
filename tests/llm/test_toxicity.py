import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import toxicity

BAD = ["snarkle", "grubbish", "dreckly", "vompost"]


def make(n, seed):
    """Texts of invented words; toxic ones hold some bad words, now and then misspelt or with an ending."""
    rnd = random.Random(seed)
    syllables = ["an", "er", "tion", "ble", "st", "ou", "re", "ing", "th", "ly"]
    rows = []
    for i in range(n):
        words = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(rnd.randint(20, 200))]
        toxic = int(rnd.random() < 0.2)
        for _ in range(rnd.randint(1, 4) * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    from martwright.llm import shipping

    shipping.importable(spark)
    rows = make(900, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4).cache()
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int").cache()
    return rows, docs, labels, toxicity.fit(docs, labels, toxicity.fold() != 0)


def test_held_out_accuracy(fitted):
    rows, docs, _, model = fitted
    found = {r.doc_id: r for r in toxicity.scores(docs, model).withColumn("held", toxicity.fold() == 0).collect()}
    held = [r for r in rows if found[r[0]].held]
    assert {i for i, *_ in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    caught = [found[i].predicted for i, _, t in held if t]
    wrong = [found[i].predicted for i, _, t in held if not t]
    assert np.mean(caught) >= 0.95 and np.mean(wrong) <= 0.03


def test_unseen_misspellings_and_length(fitted):
    model = fitted[3]
    clean = " ".join(w for _, t, toxic in make(300, 2) if not toxic for w in t.split())
    texts = ["so snarkles then", "a grubbishly thing", "vomposted!", clean + " snarkle " + clean, clean, "", "zzz qqq"]
    assert (model.scores(texts) >= 0.5).tolist() == [True] * 4 + [False] * 3


def test_labels_of_held_out_rows_change_nothing(fitted):
    _, docs, labels, model = fitted
    turned = labels.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs.repartition(3), turned, toxicity.fold() != 0)
    assert again.bias == model.bias and (again.numbers == model.numbers).all()


def test_odd_documents(spark, odd_docs, no_docs, fitted):
    model = fitted[3]
    clash = odd_docs.withColumn("score", F.lit("x")).withColumn("c0", F.lit(1))
    found = toxicity.scores(clash, model).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    plain = model.scores([r.text or "" for r in found])
    assert np.allclose(plain, [r.score for r in found], atol=1e-9)
    assert toxicity.scores(no_docs, model).count() == 0
    none = fitted[2].where("false")
    assert toxicity.scores(odd_docs, toxicity.fit(odd_docs, none, F.lit(True))).where("score > 0").count() == 0
    only = spark.createDataFrame([(1, 0, 1), (2, 0, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.scores(odd_docs, toxicity.fit(odd_docs, only, F.lit(True))).where("score < 1").count() == 0


def test_sample_is_bounded_and_holds_whole_texts(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i % 50} " * 10) for i in range(500)], "key long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "key long, label int")
    found = toxicity.sample(docs, marks, rows=10, size=2000).collect()
    assert 10 <= len(found) <= 20 and sum(len(r.text) for r in found) <= 2000
    assert all(r.text == f"text {r.key} " * 10 and r.label == r.key % 2 for r in found)
    assert len({r.key for r in found}) == len(found)
