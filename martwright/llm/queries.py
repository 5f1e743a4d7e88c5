"""The operators' queries over the test tables, each beside its SQL counterpart where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import (
    infill,
    mixing,
    packing,
    phrases,
    quality,
    secret_scan,
    sharding,
    shipping,
    simhash,
    suffixes,
    tokens,
    toxicity,
    vectors,
    wrappers,
)
from martwright.operators.workspace import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipping.importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MIX_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s,
         coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         md5('mix' || coalesce(':' || doc_id::VARCHAR, '')) AS o
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY s ORDER BY o, n_bytes
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM sized),
totals AS (SELECT s, sum(n_bytes)::DOUBLE AS b FROM sized GROUP BY s),
shares AS (
  SELECT s, greatest(1, round(1000 * pow(b, 0.5)
         / greatest((SELECT sum(pow(b, 0.5)) FROM totals), 1.0)))::BIGINT AS e FROM totals),
one AS (SELECT list({'s': s, 'e': e} ORDER BY s) AS arr, sum(e)::BIGINT AS h FROM shares),
edf AS (
  SELECT 0::BIGINT AS t, list_transform(arr, lambda x: 0::BIGINT) AS done, 0::BIGINT AS pick, 0::BIGINT AS k FROM one
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(done) + 1), lambda j: done[j] + CASE WHEN j = p THEN 1 ELSE 0 END),
         p, done[p]
  FROM (SELECT t, done, list_min(list_transform(
               list_filter(range(1, len(arr) + 1),
                 lambda j: done[j] < arr[j].e AND (done[j] * h) // arr[j].e <= t),
               lambda j: {'d': ((done[j] + 1) * h + arr[j].e - 1) // arr[j].e, 'j': j})).j AS p
        FROM edf, one WHERE t < h)),
turns AS (SELECT arr[pick].s AS s, arr[pick].e AS e, h, k, t - 1 AS turn FROM edf, one WHERE t > 0)
SELECT p.doc_id, p.source, p.n_bytes, p.pos // 65536 AS block, p.pos % 65536 AS place,
       (p.pos // 65536) // e * h + (k * h) // e AS release,
       (p.pos // 65536) // e * h + ((k + 1) * h + e - 1) // e AS deadline,
       (p.pos // 65536) // e * h + turn AS slot
FROM placed p JOIN turns t ON t.s = p.s AND t.k = (p.pos // 65536) % t.e
"""


@query("op1_mix_sources", MIX_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    return mixing.mix(docs, size=F.col("n_bytes"))


SHARD_BYTES = 1 << 20

SHARD_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 6) AS hex FROM documents),
b AS (
  SELECT doc_id, n_bytes, list_aggregate(list_transform(range(1, 25), lambda i:
    ((('0x' || hex)::BIGINT >> (24 - i)) & 1)::VARCHAR), 'string_agg', '') AS bits FROM d),
lv AS (SELECT doc_id, n_bytes, bits, g.depth, substr(bits, 1, g.depth::INT) AS px
       FROM b, range(0, 25) AS g(depth)),
s AS (SELECT depth, px, sum(n_bytes) AS total, count(*) AS docs FROM lv GROUP BY ALL),
leaf AS (
  SELECT lv.doc_id, lv.n_bytes, min(lv.depth) AS depth, any_value(bits) AS bits
  FROM lv JOIN s USING (depth, px) WHERE total <= {SHARD_BYTES} OR docs = 1 GROUP BY ALL)
SELECT doc_id, n_bytes, substr(bits, 1, depth::INT) AS shard, depth::INT AS depth, 0::BIGINT AS page FROM leaf
"""


@query("op4_extendible_shards", SHARD_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    )
    return sharding.shards(docs, SHARD_BYTES, size=F.col("n_bytes"))


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listed("base").cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"),
    )


def _quality_sql() -> str:
    white = r"[ \t\n\x0b\f\r]"
    rules = {name: rule.replace(" DIV ", " // ") for name, (rule, _, _) in quality.MEASURES.items()}
    values = " UNION ALL ".join(
        f"SELECT l, s, '{name}' AS measure, ({rule})::BIGINT AS v FROM f WHERE NOT base_failed"
        for name, rule in rules.items()
    )
    bounds = ", ".join(
        f"""{"-1" if down is None else f"max(q1 - 3 * (q3 - q1) - {down}) FILTER (measure = '{name}')"} AS {name}_low,
        max(q3 + 3 * (q3 - q1) + {up}) FILTER (measure = '{name}') AS {name}_high"""
        for name, (_, up, down) in quality.MEASURES.items()
    )
    inside = " AND ".join(f"({rule}) BETWEEN {name}_low AND {name}_high" for name, rule in rules.items())
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce('=' || lang, '') AS l, coalesce('=' || source, '') AS s, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+') AS words FROM documents),
tri AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n FROM
        (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tri WHERE c > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS ls FROM w),
f AS (
  SELECT w.doc_id, l, s, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '{white}', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(words) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(words) AS base_failed
  FROM w JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
v AS ({values}),
sk AS (SELECT l, s, measure, (v >> greatest(length(bin(v)) - 4, 0)) << greatest(length(bin(v)) - 4, 0) AS bucket FROM v),
lv AS (SELECT 0 AS level, l, s, measure, bucket FROM sk UNION ALL SELECT 1, l, '', measure, bucket FROM sk
       UNION ALL SELECT 2, '', '', measure, bucket FROM sk),
c AS (SELECT level, l, s, measure, bucket, count(*) AS n FROM lv GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY level, l, s, measure) AS total,
             sum(n) OVER (PARTITION BY level, l, s, measure ORDER BY bucket) AS upto FROM c),
q AS (SELECT level, l, s, measure, max(total) AS total, min(bucket) FILTER (4 * upto >= total) AS q1,
             min(bucket) FILTER (4 * upto >= 3 * total) AS q3 FROM r GROUP BY ALL),
g AS (SELECT DISTINCT l, s FROM sk),
pick AS (
  SELECT g.l, g.s, q.measure, arg_min(q1, level) AS q1, arg_min(q3, level) AS q3
  FROM g JOIN q ON (level = 0 AND q.l = g.l AND q.s = g.s) OR (level = 1 AND q.l = g.l) OR level = 2
  WHERE total >= 100 OR level = 2 GROUP BY ALL),
lim AS (SELECT l, s, {bounds} FROM pick GROUP BY l, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {inside}, FALSE) AS kept
FROM f LEFT JOIN lim USING (l, s)
"""


@query("op7_quality_rules", _quality_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    featured = cut_lineage(quality.features(docs).drop("text"))
    return quality.fenced(featured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.counts(table(spark, sf_dir, "documents"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"))
    return packing.pack(cut.withColumnRenamed("key", "doc_id"))


@query("op9_simhash_classes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_kmeans_tree_search")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"))


@query("op6_wrapper_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op3_cut_repeats")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.cut_repeats(table(spark, sf_dir, "documents"))


PHRASES_SQL = r"""
WITH piece AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\n\x0b\f\r]')) AS body FROM documents),
w AS (SELECT lang, regexp_extract_all(body, '[^ \t]+') AS ws FROM piece),
g AS (SELECT lang, s.size AS size, list_transform(range(1, len(ws) - s.size + 2),
        lambda i: array_to_string(ws[i:i + s.size - 1], ' ')) AS found
      FROM w, (VALUES (1), (2), (3)) AS s(size)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM (SELECT lang, size, unnest(found) AS phrase FROM g) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE size > 1 AND f >= 10),
cut AS (SELECT lang, size, phrase, ws, a, k, array_to_string(ws[1:k], ' ') AS p, array_to_string(ws[k + 1:], ' ') AS q
        FROM c, (VALUES (1), (2)) AS t(k) WHERE k < size),
s AS (SELECT cut.lang, cut.phrase, cut.a, k, x.f AS l, y.f AS r,
        (1000000::HUGEINT * cut.a * cut.a) // (x.f::HUGEINT * y.f) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p JOIN f y ON y.lang = cut.lang AND y.phrase = q),
worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
long AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS longer
         FROM c, (VALUES (1), (2)) AS t(i) WHERE size = 3 GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN long USING (lang, phrase)
         WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query("op11_phrase_collocations", PHRASES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


INFILL_SQL = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS us FROM documents),
d AS (
  SELECT *, len(us) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
             OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(us[1:lo], '') AS pre, array_to_string(us[lo + 1:hi], '') AS mid,
        array_to_string(us[hi + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query("op12_infill_cuts", INFILL_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.infill(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(infill.restored()).alias("restored_sha256"),
    )


@query("op13_subword_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.fold() != 0)
    found = toxicity.scores(docs, model).withColumn("held_out", F.coalesce(toxicity.fold() == 0, F.lit(False)))
    return found.select("doc_id", "held_out", "score", "predicted")
