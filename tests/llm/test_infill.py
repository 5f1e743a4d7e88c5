import hashlib
import re

from pyspark.sql import functions as F

from martwright.llm import infill


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by listing the units."""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_odd_documents_and_round_trip(odd_docs, no_docs):
    found = infill.infill(odd_docs).withColumn("back", infill.restored()).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        text = r.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, text)
        assert r.back == text
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert infill.infill(no_docs).count() == 0


def test_marks_that_arise_where_parts_meet(spark):
    texts = ["<P", "S><", "<<S", "P>M>", "<P><S><M>", "a<M>b", "<", ">", "<<<>>>S>P", "\U0001d11e e\u0301 \r\n"]
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    docs = docs.withColumn("output", F.lit(3)).withColumn("c1", F.lit("kept"))
    for r in infill.infill(docs).withColumn("back", infill.restored()).collect():
        assert r.back == r.text and r.c1 == "kept"
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
