import numpy as np

from martwright.llm import vectors


def brute(rows, k, every):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float64)
    want = {}
    for i, x in rows:
        if i % every == 0:
            score = (v * np.array(x, np.float64)).sum(1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            want[i] = [(int(ids[j]), float(score[j])) for j in order]
    return want


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 30] * rng.uniform(0.5, 2) + rng.normal(size=16) * 0.4]) for i in range(6000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = found(vectors.search(frame, sample=3000, leaf_points=32, cell=200)), brute(rows, 20, 20)
    assert got.keys() == want.keys()
    hits = [len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want]
    assert np.mean(hits) >= 0.9
    exact = {i: dict(x) for i, x in brute(rows, 6000, 20).items()}
    assert all(abs(exact[i][j] - s) < 1e-12 for i in got for j, s in got[i])


def test_odd_vectors(spark):
    """Ties, copies, nulls and zeros; small enough that all leaves are read."""
    good = [(i, [float(i % 3), 1.0]) for i in range(100)]
    odd = [(200, None), (220, [0.0, 0.0]), (240, [None, 1.0]), (260, [float("nan"), 1.0]), (280, [float("inf"), 1.0]), (None, [1.0, 1.0]), (300, [1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in good + odd], "vec_id long, embedding array<float>, leaf string")
    assert found(vectors.search(frame, leaf_points=10, recall=2.0, cell=16)) == brute(good, 20, 20)
    few = spark.createDataFrame(good[:5], "vec_id long, embedding array<float>")
    assert found(vectors.search(few)) == brute(good[:5], 20, 20)
    assert vectors.search(frame.where("false")).count() == 0


def test_query_equals_brute_force_on_the_small_table(spark):
    from martwright.llm import queries

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got, want = found(queries.QUERIES["op10_kmeans_tree_search"](spark, "/root/testdata/sf0.001")), brute(rows, 20, 20)
    assert np.mean([len({j for j, _ in got[i]} & {j for j, _ in want[i]}) / 20 for i in want]) >= 0.9
