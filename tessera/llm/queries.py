"""The queries of this package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat_tree, decontaminate, fingerprint, html_extract, jaccard_join, mixing, quality, suffix_dedup, token_scan, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_digest(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.classify(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = toxicity.tag(docs, toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id")))))
    return out.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["start"], x["end"])), ",").alias("spans"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents")).drop("rid", "root")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


OP5_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN sh USING (doc_id) GROUP BY ALL),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM both_ JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS r FROM documents UNION SELECT l.a, reach.r FROM links l JOIN reach ON l.b = reach.a),
comp AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, component_id, (SELECT count(*) FROM links WHERE a = n.doc_id) AS n_links FROM n JOIN comp USING (doc_id)
"""


#: Conversation -7: turns that look like the template's own control strings and escapes.
HARD_TURN = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = [(-7, 0, "user", HARD_TURN), (-7, 1, "assistant", HARD_TURN)]
    more = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(x).alias("text")) for c, t, r, x in hard])))
    return chat_tree.read_back(chat_tree.conversations(chat_tree.pack_conversations(turns.unionByName(more)))).drop("n_tokens")


OP8_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok', NULL UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok', NULL),
esc AS (
  SELECT *, length(replace(replace(replace(text, '\\', '\\\\'), '### ', '\\### '), '</turn>', '\\</turn>')) AS n_text,
    length(replace(replace(replace(replace(role, '\\', '\\\\'), '### ', '\\### '), '</turn>', '\\</turn>'), ':', '\\:')) AS n_role FROM rows)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(4 + n_role + 2 + n_text + 7 + 1) AS BIGINT) AS formatted_chars
FROM esc GROUP BY conv_id, own
"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.document_token_counts(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH sized AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS DOUBLE) AS w, 3.0::DOUBLE * source_size AS most FROM src),
lv AS (
  SELECT *, most / w AS ratio,
    ((SELECT sum(source_size) FROM src) - coalesce(sum(most) OVER (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY most / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
one AS (SELECT arg_min(level, ratio) AS level FROM lv WHERE level <= ratio),
goal AS (SELECT source, source_size, coalesce(least(most, w * one.level), most) AS target FROM lv, one),
tiered AS (SELECT s.*, g.source_size, g.target, s.size > 0.01 * g.target AS big FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
placed AS (SELECT *, row_number() OVER (PARTITION BY source, big ORDER BY size, ((doc_id % 64) + 64) % 64, doc_id) - 1 AS ahead,
  CAST(('0x' || substr(md5('0:' || coalesce(source, chr(0) || 'null')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM tiered),
bigs AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0 END AS e FROM placed WHERE big),
bigc AS (SELECT *, CAST(floor(u + (ahead + 1) * e) - floor(u + ahead * e) AS BIGINT) AS copies FROM bigs),
done AS (SELECT source AS d_source, sum(copies * size) AS d_taken, sum(size) AS d_size FROM bigc GROUP BY source),
smalls AS (
  SELECT p.*, CASE WHEN source_size - coalesce(d_size, 0) > 0
    THEN least(greatest((target - coalesce(d_taken, 0)) / (source_size - coalesce(d_size, 0)), 0), 3.0) ELSE 0 END AS e
  FROM placed p LEFT JOIN done ON source IS NOT DISTINCT FROM d_source WHERE NOT big),
smallc AS (SELECT *, CAST(floor(u + (ahead + 1) * e) - floor(u + ahead * e) AS BIGINT) AS copies FROM smalls)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM bigc
UNION ALL
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM smallc
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_decontaminate": op2_decontaminate,
        "op3_quality": op3_quality,
        "op4_html_text": op4_html_text,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_fingerprints": op6_fingerprints,
        "op7_mix": op7_mix,
        "op8_chat_format": op8_chat_format,
        "op9_toxic_spans": op9_toxic_spans,
        "op10_token_counts": op10_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_jaccard_join": OP5_SQL, "op7_mix": OP7_SQL, "op8_chat_format": OP8_SQL}
