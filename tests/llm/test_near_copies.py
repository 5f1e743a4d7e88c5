import random

import corpus_pipeline
from martwright.llm import near_copies


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_classes(texts, least=0.8):
    sets = [plain_shingles(t) for t in texts]
    name = list(range(len(texts)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= least * len(a | b) and bool(a) == bool(b):
                links += 1
                name[root(i)] = root(j)
    return [root(i) for i in range(len(texts))], links


def test_edited_copies_against_brute_force(spark):
    """Copies with some words changed, dropped or moved, and copies of copies."""
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(60):
        words = rnd.choices(vocabulary, k=rnd.randint(60, 300))
        for _ in range(rnd.choice([1, 2, 4, 8])):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 40))):
                at = rnd.randrange(len(words))
                words[at : at + rnd.choice([0, 1])] = rnd.choices(vocabulary, k=rnd.choice([0, 1]))
    texts += [texts[0].upper(), texts[3].replace(" ", "\n"), "", None, "", "a b c", "a b  c", "a b d"]
    keys = [None if rnd.random() < 0.1 else i // 2 for i in range(len(texts))]  # ids are lost or repeated
    docs = spark.createDataFrame(list(zip(keys, texts, range(len(texts)), strict=True)), "doc_id long, text string, at long")
    want, links = plain_classes(texts)
    assert links > 60
    kept = [r.at for r in corpus_pipeline.near_duplicates(spark, docs.repartition(3), "").collect()]
    assert sorted(want[i] for i in kept) == sorted(set(want))  # one of each class, and of every class
    least = {}
    for i, c in enumerate(want):
        least[c] = min(least.get(c, (True, 0)), (keys[i] is None, keys[i] or 0))
    assert all((keys[i] is None, keys[i] or 0) == least[want[i]] for i in kept)
    assert near_copies.one_of_each(docs.where("false")).count() == 0


def test_a_cell_may_span_batches(spark):
    import pyarrow as pa

    rows = [(p, 0, 0, n) for p in range(40) for n in range(1 + p % 3)] + [(99, 0, b, n) for b in (0, 1) for n in range(50)]
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    whole = pa.record_batch(columns, ["part", "a", "b", "node"])
    batches = [whole.slice(at, 4) for at in range(0, len(rows), 4)] + [whole.slice(0, 0)]
    found = [tuple(zip(*(c.to_pylist() for c in cell.columns), strict=True)) for cell in near_copies.cells(iter(batches), ["part", "a", "b"])]
    assert [r for cell in found for r in cell] == rows
    assert len(found) == 42 and all(len({r[:3] for r in cell}) == 1 for cell in found)


def test_no_link_is_lost_between_chunks(spark, monkeypatch):
    """Many drifting copies of one text and unlike texts that share a passage, in cells of four."""
    monkeypatch.setattr(near_copies, "CELL", 4)
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(2000)]
    words, texts = rnd.choices(vocabulary, k=150), []
    for _ in range(60):
        texts.append(" ".join(words))
        words = list(words)
        words[rnd.randrange(150)] = rnd.choice(vocabulary)
    passage = rnd.choices(vocabulary, k=120)
    texts += [" ".join(passage + rnd.choices(vocabulary, k=60)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, _ = plain_classes(texts)
    kept = sorted(r.doc_id for r in near_copies.one_of_each(docs.repartition(3)).collect())
    assert kept == sorted(set(want)) and len(kept) > 40


def test_fingerprints_of_similar_texts_are_near():
    """Pairs 0.8 alike keep within NEAR bits, few strangers do (texts of few shingles), and pivots part no pair."""
    import numpy as np

    rng = np.random.default_rng(5)
    prints = []
    for n in [4, 8, 40, 400, 5000] * 40:
        same, own = rng.integers(0, 2**64, n, dtype=np.uint64), max(1, n // 4)
        a = np.concatenate([same, rng.integers(0, 2**64, own // 2, dtype=np.uint64)])
        b = np.concatenate([same, rng.integers(0, 2**64, own - own // 2, dtype=np.uint64)])
        prints += [near_copies.fingerprint_of(a), near_copies.fingerprint_of(b)]
    prints = np.stack(prints)
    table = near_copies.pivot_table(prints)
    assert table.shape == (400, near_copies.PIVOTS)
    for x in range(0, 400, 2):
        far = near_copies.bits_apart(prints[x], prints)
        assert far[x + 1] <= near_copies.NEAR and (np.delete(far, [x, x + 1]) <= near_copies.NEAR).sum() <= 8
        assert np.abs(table[x] - table[x + 1]).max() <= far[x + 1]
