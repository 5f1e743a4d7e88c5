"""Fill-in-the-middle: texts cut at two unit boundaries and put in a new order.

A text's units are runs of ASCII letters and single other characters. One full match of ``(unit)*``
keeps every repetition of the group, so that the list of the group's ends tells the number of units
and both offsets at which the text is cut. The cuts and the form follow from the digest of ``1:`` and
the document's key, so that a document always gets the same output.

``plain`` leaves the text alone: it is empty, holds a mark itself, or is one of the share that is not
transformed. ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle, each after its mark. A
mark starts with a character that occurs only there, so marks that arise where parts meet are no
matter, and ``restored`` is exact.

Defined results: null texts are empty; a null key counts as no digits after ``1:``; repeated rows get
equal outputs; columns named like the new ones are replaced; an empty table stays empty. Offsets count
code points. The match keeps some 20 bytes a unit, for one text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS = r"([A-Za-z]+|[^A-Za-z])*"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents, those that are transformed, and of them those with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Characters of output that a task gathers before it hands them on.
GATHERED = 1 << 23

ADDED = (
    T.StructType()
    .add("n", T.LongType())
    .add("form", T.StringType())
    .add("prefix_chars", T.LongType())
    .add("middle_chars", T.LongType())
    .add("output", T.StringType())
)


def infilled(text: str, key: str, units) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text; ``units`` is the compiled pattern."""
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    one, two, whether, which = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or whether % 100 >= TRANSFORMED or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = (ends[k - 1] if k else 0 for k in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if which % 100 < SUFFIX_FIRST:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, low, high - low, output


def infill(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output."""
    carried = [c for c in docs.columns if c not in ADDED.fieldNames()]
    inputs = docs.select(F.col(key).cast("string"), F.col(text).cast("string"), *carried)
    # The inputs come first, under names by place: the carried columns may have any name.
    inputs = inputs.toDF(*[f"c{i}" for i in range(len(inputs.columns))])
    kept = T.StructType([docs.schema[c] for c in carried])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        units = regex.compile(UNITS)
        for batch in batches:
            start, size, made = 0, 0, []
            for at in range(batch.num_rows):
                k, t = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                made.append(infilled(t or "", k or "", units))
                size += len(made[-1][-1])
                if size >= GATHERED or at + 1 == batch.num_rows:
                    rows = batch.slice(start, at + 1 - start)
                    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                    added = [pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), types, strict=True)]
                    yield pa.record_batch(
                        [*rows.columns[2:], *added], [*kept.fieldNames(), *ADDED.fieldNames()]
                    )
                    start, size, made = at + 1, 0, []

    return inputs.mapInArrow(transform, T.StructType([*kept.fields, *ADDED.fields]))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(F.col(form) == "psm", F.concat(part(1), part(3), part(2)))
        .when(F.col(form) == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(F.col(output))
    )
