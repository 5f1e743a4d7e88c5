"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Patterns find assignments to secret-looking names, access keys and long hexadecimal strings. Beyond
them, runs of token characters that hold a letter and a digit are scored by two first-order Markov
models of characters, one of random strings and one of ordinary identifiers; a run is reported when
the log-likelihood ratio exceeds ``log_odds`` (how much rarer secrets are than identifiers).

The models are trained from labelled strings: random ones are the values that the patterns found and
digests written in hexadecimal, base 64 and base 36; ordinary ones are words of documents that are no
runs to be scored: a run's label is unknown, and random ones would be learnt as ordinary. Both
come from ``train_docs`` texts, and each class is bounded by ``train_rows`` strings (taken in the order
of their hash). Everything is expressed by
built-in functions; positions follow from the lengths of the pieces before a match.

Defined results: null texts are empty; a text without matches has empty span lists; repeated rows
get equal results; an empty table gives no rows; without training words nothing is added.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

#: kind -> (pattern, least length of its value); the value is the pattern's only group. A short assignment
#: is dropped after it has been matched, since it may cover the name of another. The other kinds are whole
#: runs, which no shorter match can cut: their length is part of the pattern.
KINDS: dict[str, tuple[str, int]] = {
    "assign": (
        r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        8,
    ),
    "access": (r"(AKIA[A-Z0-9]{12,})", 16),
    "hex": (r"([0-9a-f]{32,})", 32),
}
#: Fewest characters of a run that is scored.
SCORED = 20
#: Cheap tests that hold whenever a kind has a match that counts.
HINTS = {
    "assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}",
    "access": "AKIA[A-Z0-9]{12}",
    "hex": "[0-9a-f]{32}",
    "random": f"[A-Za-z0-9+/_=-]{{{SCORED}}}",
}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Weight, in characters, of the single characters' frequencies in the pairs' probabilities.
BACKOFF = 20
WORD = "[A-Za-z0-9+/_=-]"
NO_SPANS = "cast(array() AS array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>)"


def _spans(text: str, kind: str, rank: int, pattern: str, least: int) -> Column:
    """Spans of all leftmost matches, of values of ``least`` characters; ``\\G`` ties each gap to the match before."""
    gapped = F.lit(rf"(?s)\G(.*?){pattern}")
    whole, gap, value = (F.regexp_extract_all(F.col(text), gapped, F.lit(i)) for i in (0, 1, 2))
    pieces = F.arrays_zip(whole.alias("w"), gap.alias("g"), value.alias("v"))
    empty = F.struct(F.lit(0).cast("bigint").alias("pos"), F.expr(NO_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["pos"] + F.length(x["w"])
        span = F.struct(
            (acc["pos"] + F.length(x["g"])).alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            x["v"].alias("value"),
        )
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    found = F.aggregate(pieces, empty, step, lambda acc: acc["out"])
    counted = F.filter(found, lambda s: F.length(s["value"]) >= least)
    return F.when(F.col(text).rlike(HINTS[kind]), counted).otherwise(F.expr(NO_SPANS))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_text`` (never null) and ``_base``: the patterns' spans by start, then kind."""
    found = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    parts = [
        _spans("_text", kind, rank, pattern, least)
        for rank, (kind, (pattern, least)) in enumerate(KINDS.items())
    ]
    return found.withColumn("_base", F.array_sort(F.concat(*parts)))


def _mixed(run: Column) -> Column:
    """Whether a run holds a letter and a digit."""
    return run.rlike("[0-9]") & run.rlike("[A-Za-z]")


def sampled(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """The ``rows`` different texts, not empty, that are first by their hash; only hashes meet in one task."""
    hashed = docs.where(F.length(text) > 0).select(F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    last = hashed.select("_hash").distinct().orderBy("_hash").limit(rows).agg(F.max("_hash"))
    return hashed.where(F.col("_hash") <= last.scalar()).groupBy("_hash").agg(F.first("_text").alias("_text"))


def training_strings(docs: DataFrame, text: str, train_rows: int, train_docs: int) -> DataFrame:
    """Rows (random, string): bounded, labelled samples, chosen by hash."""
    spark = docs.sparkSession
    first = lambda df, n: df.distinct().orderBy(F.md5(F.col("string").cast("binary"))).limit(n)
    sample = cut_lineage(sampled(docs, text, train_docs))
    known = first(base_spans(sample, "_text").select(F.explode("_base.value").alias("string")), train_rows)
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    made = spark.range(train_rows // 4).select(
        F.explode(
            F.array(
                F.substring(F.base64(F.unhex(digest)), 1, 40),
                F.substring(digest, 1, 40),
                F.conv(F.substring(digest, 1, 15), 16, 36),
                F.lower(F.conv(F.substring(digest, 16, 15), 16, 36)),
            )
        ).alias("string")
    )
    clean = F.regexp_replace("_text", KINDS["assign"][0] + "|AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", " ")
    words = first(
        sample.select(F.explode(F.regexp_extract_all(clean, F.lit(f"{WORD}{{6,}}"), F.lit(0))).alias("string")).where(
            ~((F.length("string") >= SCORED) & _mixed(F.col("string")))
        ),
        train_rows,
    )
    return known.unionByName(made).select(F.lit(1).alias("random"), "string").unionByName(
        words.select(F.lit(0).alias("random"), "string")
    )


def train(strings: DataFrame) -> DataFrame:
    """One row, ``model``: for each pair of characters 1000 x the log ratio of its two probabilities."""
    n = len(ALPHABET)
    pairs = (
        strings.select(
            "random",
            F.explode(
                F.expr(
                    "transform(sequence(1, greatest(length(string) - 1, 1)), i -> struct("
                    f" instr('{ALPHABET}', substr(string, i, 1)) - 1 AS a,"
                    f" instr('{ALPHABET}', substr(string, i + 1, 1)) - 1 AS b))"
                )
            ).alias("p"),
        )
        .where("length(string) > 1 AND p.a >= 0 AND p.b >= 0")
        .groupBy("p.a", "p.b")
        .agg(
            F.sum("random").alias("r"),
            F.sum(1 - F.col("random")).alias("o"),
        )
    )
    firsts = pairs.groupBy("a").agg(F.sum("r").alias("tr"), F.sum("o").alias("to"))
    every = strings.sparkSession.range(n * n).select(
        (F.col("id") / n).cast("int").alias("a"), (F.col("id") % n).cast("int").alias("b"), "id"
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    # What a model has seen little of falls back on how often the second character occurs at all.
    seen = pairs.groupBy("b").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    whole = Window.partitionBy(F.lit(0))
    often = lambda c: (zero(c) + 1) / (F.sum(zero(c)).over(whole) + n)
    seconds = (
        strings.sparkSession.range(n)
        .select(F.col("id").cast("int").alias("b"))
        .join(seen, "b", "left")
        .select("b", often("r").alias("ur"), often("o").alias("uo"))
    )
    chance = lambda c: (zero(c) + BACKOFF * F.col(f"u{c}")) / (zero(f"t{c}") + BACKOFF)
    ratio = F.log(chance("r")) - F.log(chance("o"))
    return (
        every.join(firsts, "a", "left")
        .join(seconds, "b")
        .join(pairs, ["a", "b"], "left")
        .groupBy()
        .agg(F.sort_array(F.collect_list(F.struct("id", F.round(1000 * ratio).cast("bigint").alias("v")))).alias("m"))
        .select(F.col("m.v").alias("model"))
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    log_odds: float = 12.0,
    train_rows: int = 20000,
    train_docs: int = 2000,
) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, rank, end, kind, value).

    ``spans`` holds the base spans and, of kind ``random``, those that the models add; a run that
    overlaps a base span is not added again.
    """
    based = base_spans(docs, text)
    model = cut_lineage(train(training_strings(docs, text, train_rows, train_docs)))
    # One pass over a run's characters, with the place of the one before in the alphabet.
    place = f"cast(instr('{ALPHABET}', c) - 1 AS int)"
    score = (
        "aggregate(regexp_extract_all(x.value, '.', 0), struct(-1 AS p, 0L AS s), (a, c) -> struct("
        f"{place} AS p, a.s + if(a.p < 0, 0L, _model[a.p * {len(ALPHABET)} + {place}]) AS s), a -> a.s)"
    )
    runs = based.withColumn("_runs", _spans("_text", "random", len(KINDS), f"({WORD}{{{SCORED},}})", SCORED))
    mixed = F.filter(
        "_runs",
        lambda x: _mixed(x["value"])
        & ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    scored = (
        runs.withColumn("_runs", F.when(F.size("_runs") > 0, mixed).otherwise(F.col("_runs")))
        .withColumn("_model", model.scalar())
        .withColumn("_added", F.expr(f"filter(_runs, x -> {score} > {round(1000 * log_odds)})"))
    )
    return (
        scored.withColumn("base", F.col("_base"))
        .withColumn("spans", F.array_sort(F.concat("_base", "_added")))
        .drop("_text", "_base", "_runs", "_model", "_added")
    )


def listed(spans: str) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(
        F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(scanned: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``scanned`` with every span of its text replaced by ``mark``; overlapping spans share one mark."""
    start = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        clean = F.substr(F.col(text), (acc["pos"] + 1).cast("int"), (s["start"] - acc["pos"]).cast("int"))
        return F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(s["start"] >= acc["pos"], F.concat(acc["out"], clean, F.lit(mark)))
            .otherwise(acc["out"])
            .alias("out"),
        )

    rest = lambda acc: F.concat(acc["out"], F.substr(F.col(text), (acc["pos"] + 1).cast("int")))
    return scanned.withColumn(
        text, F.when(F.size("spans") > 0, F.aggregate("spans", start, step, rest)).otherwise(F.col(text))
    )
