"""Quality rules whose limits follow from the corpus: quantile sketches per language and source.

Every document gets whole-number measures (mean word length, symbols, repeated lines, repeated word
windows). A sketch of a measure counts documents per value, with values cut to four significant
bits: a relative error of at most one eighth, at most 16 buckets for each power of two, and two
sketches are merged by adding counts. Sketches of (language, source) are merged upwards into one per
language and one of everything, and a group with fewer than ``min_docs`` documents takes the limits
of the next larger group. A document is rejected when a measure lies outside the far fences,
``fence`` interquartile ranges (and a slack for measures that hardly vary) beyond the quartiles.

Defined results: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

WHITE = " \t\n\x0b\f\r"
SPLIT = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "#*$%&|<>"

#: measure -> (whole-number SQL over the counts, slack of the upper fence, slack of the lower one).
#: A slack of None leaves that side open.
MEASURES: dict[str, tuple[str, int, int | None]] = {
    "word_length": ("100 * word_chars DIV n_words", 150, 150),
    "symbols": ("1000 * n_symbols DIV n_words", 150, None),
    "dup_lines": ("1000 * n_dup_lines DIV n_lines", 250, None),
    "repeats": ("1000 * n_repeat_words DIV n_words", 150, None),
}


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    Three-word windows are compared by their 64-bit hash. Columns of these names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(WHITE))
    nothing = F.array().cast("array<string>")
    lined = (
        docs.withColumn("_body", body)
        .withColumn("_words", F.when(trimmed == "", nothing).otherwise(F.split(trimmed, SPLIT)))
        .withColumn("_lines", F.filter(F.split("_body", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines")))
        .withColumn("word_chars", F.length(F.translate("_body", WHITE, "")).cast("long"))
        .withColumn(
            "n_symbols",
            F.length("_body").cast("long") - F.length(F.translate("_body", SYMBOLS, "")),
        )
    )
    hashed = lined.withColumn(
        "_sorted",
        F.expr(
            "CASE WHEN n_words > 3 THEN array_sort(transform(sequence(0, size(_words) - 3),"
            " i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS h, i AS i))) END"
        ),
    )
    again = hashed.withColumn(
        "_again",
        F.expr(
            "sort_array(transform(filter(_sorted, (x, k) -> x.h = get(_sorted, k - 1).h"
            " OR x.h = get(_sorted, k + 1).h), x -> x.i))"
        ),
    )
    counted = again.withColumn(
        "n_repeat_words",
        F.expr(
            "coalesce(aggregate(_again, struct(-3 AS last, 0L AS total),"
            " (a, i) -> struct(i AS last, a.total + least(3, i - a.last) AS total), a -> a.total), 0L)"
        ),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop("_body", "_words", "_lines", "_sorted", "_again")


def _value(rule: str) -> Column:
    """A measure; null for documents that fail the base rules, which may have neither words nor lines.

    A condition of its own: beside another one in an AND the division would be made for all rows.
    """
    return F.when(~F.col("base_failed"), F.expr(rule))


def _key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def sketches(featured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts per (language key, source key, measure, bucket) of the documents that pass the base rules."""
    values = [
        F.struct(F.lit(name).alias("measure"), _value(rule).cast("long").alias("value"))
        for name, (rule, _, _) in MEASURES.items()
    ]
    shift = "greatest(length(bin(value)) - 4, 0)"
    return (
        featured.where(~F.col("base_failed"))
        .select(_key(lang).alias("_lang"), _key(source).alias("_source"), F.inline(F.array(*values)))
        .withColumn("bucket", F.expr(f"shiftleft(shiftright(value, {shift}), {shift})"))
        .groupBy("_lang", "_source", "measure", "bucket")
        .agg(F.count("*").alias("docs"))
    )


def fences(sketch: DataFrame, min_docs: int = 100, fence: int = 3) -> DataFrame:
    """One row per (language, source): the lower and upper fence of every measure."""
    groups = sketch.select("_lang", "_source").distinct()
    levels = None
    for level, (lang, source) in enumerate((("_lang", "_source"), ("_lang", None), (None, None))):
        merged = sketch.groupBy(
            F.lit(level).alias("level"),
            (F.col(lang) if lang else F.lit("")).alias("_l"),
            (F.col(source) if source else F.lit("")).alias("_s"),
            "measure",
            "bucket",
        ).agg(F.sum("docs").alias("docs"))
        levels = merged if levels is None else levels.unionByName(merged)
    whole = Window.partitionBy("level", "_l", "_s", "measure")
    ranked = levels.withColumn("total", F.sum("docs").over(whole)).withColumn(
        "upto", F.sum("docs").over(whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    )
    quartiles = ranked.groupBy("level", "_l", "_s", "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )
    wide = quartiles.groupBy("level", "_l", "_s").agg(
        F.max("total").alias("total"),
        *[
            F.max(F.when(F.col("measure") == name, F.col(q))).alias(f"{name}_{q}")
            for name in MEASURES
            for q in ("q1", "q3")
        ],
    )
    limits = []
    for name, (_, up, down) in MEASURES.items():
        reach = fence * (F.col(f"{name}_q3") - F.col(f"{name}_q1"))
        limits.append((F.col(f"{name}_q3") + reach + up).alias(f"{name}_high"))
        low = F.lit(-1) if down is None else F.col(f"{name}_q1") - reach - down
        limits.append(low.cast("long").alias(f"{name}_low"))
    named = wide.select("level", "_l", "_s", "total", F.struct(*limits).alias("limits"))
    big = (F.col("total") >= min_docs) | (F.col("level") == 2)
    # Each group meets its own sketch, that of its language and that of everything.
    wanted = groups.select(
        "_lang",
        "_source",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("level"), F.col("_lang").alias("_l"), F.col("_source").alias("_s")),
                F.struct(F.lit(1).alias("level"), F.col("_lang").alias("_l"), F.lit("").alias("_s")),
                F.struct(F.lit(2).alias("level"), F.lit("").alias("_l"), F.lit("").alias("_s")),
            )
        ),
    )
    return (
        wanted.join(named.where(big), ["level", "_l", "_s"])
        .groupBy("_lang", "_source")
        .agg(F.min_by("limits", "level").alias("limits"))
        .select("_lang", "_source", "limits.*")
    )


def verdicts(
    featured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``featured`` with ``kept``: passes the base rules and lies within its group's fences."""
    inside = F.lit(True)
    for name, (rule, _, _) in MEASURES.items():
        inside = inside & _value(rule).between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    kept = F.coalesce(inside, F.lit(False))
    bounds = [c for c in limits.columns if c not in ("_lang", "_source")]
    return (
        featured.withColumn("_lang", _key(lang))
        .withColumn("_source", _key(source))
        .join(limits, ["_lang", "_source"], "left")
        .withColumn("kept", kept)
        .drop("_lang", "_source", *bounds)
    )


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts and ``kept``.

    The counts are written to the shared folder before they are used: both passes need them, and an
    optimizer that merges the second pass into the first would evaluate them once for every use.
    """
    return fenced(cut_lineage(features(docs, text)))


def fenced(featured: DataFrame) -> DataFrame:
    """Stored ``featured`` with ``kept`` by its own fences.

    Stored fences have a known size: a few groups go to the rows, which then stay in place.
    """
    return verdicts(featured, cut_lineage(fences(sketches(featured))))
