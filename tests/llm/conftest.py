import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    return [r.text or "" for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, texts):
    """Documents with nulls in any column, empty and long texts, ties, repeated rows, clashing columns."""
    from martwright.llm import shipping

    shipping.importable(spark)
    rnd = random.Random(3)
    rows = [(i, t, "en", f"src{i % 3}", len(t), i, "x") for i, t in enumerate(texts[:60])]
    rows += [(100 + i, texts[i], "en", "src0", 1, 7, None) for i in range(10)]
    rows += [(200, "word " * 30000, "fr", None, None, None, None), (201, "a" * 70000, None, "src1", 1, 1, "k")]
    rows += [(202, None, None, None, None, None, None), (203, "", "en", "src0", 0, 0, ""), (None, "lost key here", "en", "src0", 3, 1, "n")]
    rows += [(204, "same row", "en", "src0", 8, 0, "r")] * 3
    rnd.shuffle(rows)
    # k, block, e, value, key, page and the like are names that the operators use themselves.
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, k long, total string"
    ).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
