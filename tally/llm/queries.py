"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm import (
    bpe,
    decontaminate,
    exact,
    licenses,
    ngrams,
    quality,
    secrets,
    spelling,
    substrings,
    suffixes,
    toxicity,
    turns,
    urls,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    items = F.sha2(F.concat_ws(",", "items"), 256)
    return decontaminate.judged(found).select(
        "doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated"
    )


# The letters that are lower-cased.
_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BENCHMARK_SQL = f"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce({_FOLD}, ''), '{_ALNUM}') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(coalesce({_FOLD}, ''), '{_ALNUM}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM item WHERE len(w) > 0)
),
hit AS (
  SELECT d.doc_id, d.p, n.n, win.item_id
  FROM (SELECT DISTINCT n FROM win) n,
       (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM doc) d,
       win
  WHERE d.p + n.n - 1 <= len(d.w) AND win.n = n.n
    AND win.s = array_to_string(list_slice(d.w, d.p, d.p + n.n - 1), ' ')
),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY ALL),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY ALL
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return found.select("doc_id", "held_out", "score", "predicted", F.size("evidence").alias("n_evidence"))


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


SUBSTRING_SQL = """
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM doc WHERE len(w) >= 20)
),
later AS (SELECT doc_id, p FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM later),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM doc),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS s, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("removed")


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similar_sets(table(spark, sf_dir, "documents"), count_links=False)


NGRAM_SQL = f"""
WITH RECURSIVE
doc AS (SELECT doc_id, regexp_extract_all(coalesce({_FOLD}, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM doc WHERE len(w) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN link ON r = x)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    of = lambda name, kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(name)
    judged = lambda name: F.size(F.filter("spans", lambda x: x["verdict"] == name)).cast("long")
    return found.select(
        "doc_id",
        of("n_assign", 0),
        of("n_access", 1),
        of("n_hex", 2),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
        judged("live").alias("n_live"),
        judged("copied").alias("n_copied"),
    )


def _match_sql(kind: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
SELECT row, {kind} AS kind, (pos + len_gap)::BIGINT AS s, (pos + len_gap + len_match)::BIGINT AS e, value
FROM (
  SELECT *, sum(len_gap + len_match) OVER (PARTITION BY row ORDER BY i) - len_gap - len_match AS pos
  FROM (
    SELECT row, i, length(gap[i]) AS len_gap, length(hit[i]) AS len_match, val[i] AS value
    FROM (
      SELECT row, gap, hit, val, unnest(range(1, len(hit) + 1)) AS i
      FROM (
        SELECT row, string_split_regex(text, '{quoted}') AS gap,
               regexp_extract_all(text, '{quoted}', 0) AS hit, regexp_extract_all(text, '{quoted}', {group}) AS val
        FROM doc
      )
    )
  )
) WHERE length(value) >= {least}"""


_RANDOM_SQL = (
    f"length(value) >= {secrets.BARE} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') "
    f"AND len(list_distinct(string_split(value, ''))) >= {secrets.VARIED}"
)
_KIND_SQL = "['assign', 'access', 'hex', 'bare'][kind + 1]"

SECRET_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
         coalesce(lang, '') AS repository
  FROM documents
),
base AS ({_match_sql(0, secrets.ASSIGN, 2, secrets.ASSIGN_LEAST)}
  UNION ALL {_match_sql(1, secrets.ACCESS, 0, 1)}
  UNION ALL {_match_sql(2, secrets.HEX, 0, 1)}),
run AS ({_match_sql(3, secrets.RUN, 0, 1)}),
bare AS (
  SELECT * FROM run
  WHERE {_RANDOM_SQL} AND NOT regexp_matches(value, '{secrets.ACCESS}|{secrets.HEX}')
    AND (row, e) NOT IN (SELECT (row, e) FROM base WHERE kind = 0)
),
place AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
judged AS (
  SELECT value, CASE WHEN count(DISTINCT owner) >= {secrets.WIDE} THEN 'copied'
    WHEN count(DISTINCT owner) = 1 AND ({_RANDOM_SQL}) THEN 'live' ELSE 'unsure' END AS verdict
  FROM place JOIN doc USING (row) GROUP BY value HAVING min(kind) < 3
),
told AS (SELECT place.*, verdict FROM place JOIN judged USING (value) WHERE kind < 3 OR verdict = 'live'),
one AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg({_KIND_SQL} || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS b,
         string_agg({_KIND_SQL} || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
         count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'copied') AS n_copied
  FROM told GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM doc LEFT JOIN one USING (row)
"""


def one_letter_less(doc_id: Column, word: Column) -> Column:
    """Words whose CRC-32 with their id 199 divides lose the code point that it tells."""
    crc = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (crc % F.length(word)).cast("int")
    return F.when(
        crc % 199 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    ).otherwise(word)


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), change=one_letter_less)
    return spelling.spelling_variants(words)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with the faults that their CRC-32 tells."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text_of("text"), "[.!?]", ""))
    role = F.when(fault == 4, "user").otherwise(text_of("role"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return (
        rows.select(
            "conv_id", "turn", role.alias("role"), text.otherwise(text_of("text")).alias("text"), copies.alias("copies")
        )
        .withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
        .drop("copies", "copy")
    )


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    made = turns.repair(damaged(rows))
    digests = turns.text_digests(made.turns)
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        ids.alias("i")
        .join(made.summary.alias("s"), F.equal_null(F.col("i.conv_id"), F.col("s.conv_id")), "left")
        .join(digests.alias("d"), F.equal_null(F.col("i.conv_id"), F.col("d.conv_id")), "left")
        .select(
            "i.conv_id",
            *(F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


QUERIES = {
    "op2_ngram_jaccard_join": (ngram_jaccard_join, NGRAM_SQL),
    "op3_substring_dedup": (substring_dedup, SUBSTRING_SQL),
    "op6_suffix_array_dedup": (suffix_array_dedup, None),
    "op1_url_filters": (url_filters, None),
    "op5_quality_classifier": (quality_classifier, None),
    "op7_toxicity": (toxicity_scores, None),
    "op8_license_scans": (license_scans, None),
    "op4_exact_dedup": (exact_dedup, EXACT_SQL),
    "op9_benchmark_decontamination": (benchmark_decontamination, BENCHMARK_SQL),
    "op10_bpe": (bpe_round_trip, None),
    "op11_secret_scans": (secret_scans, SECRET_SQL),
    "op12_spelling_variants": (spelling_groups, None),
    "op13_conversation_repair": (conversation_repair, None),
}
