"""The queries of this subpackage as the driver runs them, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm.divergence import audit_sources
from tillscope.llm.exact import exact_groups
from tillscope.llm.licences import scan_licences
from tillscope.llm.lz import compare_with_next
from tillscope.llm.minhash import near_duplicates
from tillscope.llm.mixing import mix_sources
from tillscope.llm.packing import pack_documents
from tillscope.llm.quality import held_out, score_documents, train
from tillscope.llm.simhash import near_fingerprints
from tillscope.llm.staging import staged
from tillscope.llm.suffix import remove_repeats
from tillscope.llm.targeting import resample
from tillscope.llm.tokencount import count_tokens
from tillscope.llm.warc import page_of, page_records, pushed_filters, read_warc, write_warc
from tillscope.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_with_next(_table(spark, sf_dir, "documents"))
    return compared.withColumnRenamed("id", "doc_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = scratch_folder(spark, "warc")
    write_warc(page_records(pages), path)
    kind = pages.schema["page_id"].dataType.simpleString()
    # Payloads are decoded and measured where they are stored; revisits have headers only.
    stored = read_warc(spark, path, pushdown=True).filter("record_type = 'response'")
    revisits = read_warc(spark, path, payload=False, pushdown=True).filter(
        "record_type = 'revisit'"
    )
    records = (
        stored.withColumn("payload_length", F.octet_length("payload").cast("long"))
        .withColumn("payload_digest", F.sha1("payload"))
        .drop("payload")
        .unionByName(revisits)
        .select(
            page_of("record_id", kind).alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            "payload_digest",
            "record_type",
            page_of("refers_to", kind).alias("refers_to"),
        )
    )
    with pushed_filters(spark):
        return staged(records, "warc-records")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeats(_table(spark, sf_dir, "documents"))
    return removed.withColumnRenamed("id", "doc_id")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths, so every one gets a path by rule.

    A source is a tree of shelves of 400 documents, in folders of 20. A document that speaks of
    a licence is a licence file of its folder, and each fourth of those one of the whole shelf.
    """
    number = F.col("doc_id")
    shelf = F.concat(F.col("source"), F.lit("/"), F.floor(number / 400))
    folder = F.concat(shelf, F.lit("/"), F.floor(number / 20))
    place = F.when(number % 4 == 0, shelf).otherwise(folder)
    path = F.when(
        F.col("text").rlike("(?i)licen[cs]ed? "), F.concat(place, F.lit("/LICENSE."), number)
    ).otherwise(F.concat(folder, F.lit("/"), number, F.lit(".txt")))
    files = _table(spark, sf_dir, "documents").select(
        number.alias("id"), path.alias("path"), "text"
    )
    return scan_licences(files).withColumnRenamed("id", "doc_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(_table(spark, sf_dir, "documents"), every_digest=True)
    return groups.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_table(spark, sf_dir, "documents"))
    return packed.withColumnRenamed("id", "doc_id")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(_table(spark, sf_dir, "documents"))
    return counted.withColumnRenamed("id", "doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = train(documents, _table(spark, sf_dir, "labels"))
    return score_documents(documents, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted"
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.withColumnRenamed("id", "doc_id")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(_table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_fingerprints(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_lz_fingerprint": op1_lz_fingerprint,
    "op2_warc": op2_warc,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_licences": op4_licences,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_packing": op7_packing,
    "op8_minhash": op8_minhash,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_divergence": op12_divergence,
    "op13_simhash": op13_simhash,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digested AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest
  FROM payloads),
grouped AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM digested)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM grouped""",
    "op5_exact_dedup": """
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
grouped AS (
  SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id,
         count(*) OVER (PARTITION BY text) AS group_size FROM lowered)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM grouped""",
    "op11_importance_resampling": r"""
WITH sums AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1
                THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS sum_of
  FROM range(256) r(i)),
split AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
wanted AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
held AS (SELECT doc_id, unnest(words) AS word FROM split),
bucketed AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(
             regexp_extract_all(hex(word), '..'), lambda x: CAST('0x' || x AS BIGINT)),
             lambda c, b: xor(c >> 8, sum_of[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM held UNION SELECT word FROM wanted), sums),
s AS (SELECT bucket, count(*) AS n FROM held JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
  SELECT s.bucket, CAST(floor(1000 * ln(
      (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
      / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT)
      AS gain
  FROM s LEFT JOIN t ON s.bucket = t.bucket),
weighed AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM held JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5)::DOUBLE
           / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM split LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op12_divergence": r"""
WITH named AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text FROM documents),
held AS (
  SELECT row, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM named),
kept AS (
  SELECT lang, term, count(*) AS n FROM held GROUP BY lang, term
  HAVING count(DISTINCT row) >= 10),
langs AS (
  SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM named),
counted AS (
  SELECT h.lang, h.source, h.term, count(*) AS n
  FROM held h JOIN kept k ON h.lang = k.lang AND h.term = k.term GROUP BY ALL),
totals AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM groups g LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM totals g JOIN kept k ON g.lang = k.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT g.lang, g.source, o.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source),
terms AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank
FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank
  FROM terms) WHERE rank <= 10""",
    "op6_mixing": f"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(coalesce(len(regexp_extract_all(text, {_WORDS})), 0) AS BIGINT) AS size
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')
               || ':' || coalesce(text, '')), 1, 13) AS BIGINT)
              + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / (1.0::DOUBLE / (1.0::DOUBLE
            + abs(coalesce(length(text)::DOUBLE / greatest(size, 1), 0) - 6.0::DOUBLE)
              / 6.0::DOUBLE)) AS key
  FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE
           AS weight, 2.0::DOUBLE * source_size AS cap FROM sources),
filled AS (
  SELECT *, cap / weight AS full_at,
         row_number() OVER filling AS place,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(cap) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER ()
          - coalesce(sum(weight) OVER
                     (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed WINDOW filling AS (ORDER BY cap / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT level FROM filled WHERE level <= full_at
                              ORDER BY place LIMIT 1)) AS target
  FROM filled),
epochs AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM targets),
ordered AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
         e.target - e.epochs * e.source_size AS left_over,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken_before
  FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN left_over > 0 AND taken_before + size / 2.0::DOUBLE
                                       <= left_over THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered""",
}
