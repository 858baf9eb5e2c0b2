"""One query per corpus operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.llm import (
    ball_tree, language_crf, license_scan, line_templates, minhash, packing, piece_codec, recurrent_lm, resampling, spot_signatures, suffix_dedup,
    token_alignment, warc,
)
from veritill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_model() -> tuple[str, str, str]:
    """Tokenizer file, the same vocabulary as ranks, and its split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_digests(table(spark, sf_dir, "documents"), length=400, left_column="text")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_digests(table(spark, sf_dir, "documents"), piece_model())


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_summary(table(spark, sf_dir, "documents"))


def op4_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_and_next(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=4, percent=80)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    model = language_crf.learn(documents, ~held_out & F.col("doc_id").isNotNull())
    return language_crf.predict(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, payloads = warc.store(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.resolve(warc.read(spark, warc.export(headers, payloads)))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *byte_model())


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.without_templates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"), byte_model(), piece_model())


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"), held_out, ~held_out & F.col("doc_id").isNotNull())


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v{part} >> {shift}) & 31)::INT, 1)"
    for part in range(4)
    for shift in range(35, -1, -5)
)
_HEX = ", ".join(f"('0x' || substr(x, {1 + 10 * part}, 10))::BIGINT AS v{part}" for part in range(4))
OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS x, max(page_id) OVER (PARTITION BY body) AS holder FROM p),
v AS (SELECT *, {_HEX} FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM v
"""


OP8_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""


OP10_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
split AS (SELECT doc_id, string_split(body, chr(10)) AS own FROM docs),
each AS (SELECT doc_id, generate_subscripts(own, 1) AS i, unnest(own) AS line FROM split),
masked AS (SELECT doc_id, i, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM each),
lines AS (
  SELECT *, len(tokens) AS n FROM (
    SELECT *, list_filter(string_split(masked, ' '), lambda t: t <> '') AS tokens FROM masked)
  WHERE len(tokens) >= {line_templates.MIN_TOKENS}),
exact AS (SELECT masked, min(doc_id) AS first FROM lines GROUP BY 1 HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
longer AS (SELECT *, tokens[1:{line_templates.LEADING}] AS lead FROM lines WHERE n >= {line_templates.TREE_TOKENS}),
leaves AS (SELECT n, lead, count(*) AS lines FROM longer GROUP BY 1, 2 HAVING count(*) >= {line_templates.MIN_DOCS}),
held AS (SELECT l.*, leaves.lines FROM longer l JOIN leaves USING (n, lead)),
places AS (SELECT n, lead, lines, generate_subscripts(tokens, 1) AS p, unnest(tokens) AS token FROM held),
fixed AS (
  SELECT n, lead, p, token FROM places GROUP BY n, lead, lines, p, token
  HAVING count(*) >= {line_templates.MIN_DOCS} AND count(*) >= {line_templates.TOKEN_SHARE} * lines),
spread AS (SELECT doc_id, i, n, lead, generate_subscripts(tokens, 1) AS p, unnest(tokens) AS token FROM held),
named AS (
  SELECT s.doc_id, s.i, s.n, s.lead, s.p, coalesce(f.token, '<*>') AS token FROM spread s
  LEFT JOIN fixed f ON f.n = s.n AND f.lead = s.lead AND f.p = s.p AND f.token = s.token),
general AS (
  SELECT doc_id, i, n, lead, list(token ORDER BY p) AS template FROM named GROUP BY 1, 2, 3, 4
  HAVING count(*) FILTER (WHERE token <> '<*>') >= {line_templates.FIXED_SHARE} * n),
recurring AS (SELECT n, lead, template, min(doc_id) AS first FROM general GROUP BY 1, 2, 3
  HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
gone AS (
  SELECT doc_id, i FROM lines JOIN exact USING (masked) WHERE doc_id <> first
  UNION SELECT doc_id, i FROM general JOIN recurring USING (n, lead, template) WHERE doc_id <> first)
SELECT e.doc_id, count(*)::BIGINT AS n_lines, count(g.i)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY e.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY 1
"""


def registered() -> dict[str, Query]:
    return {
        "op1_suffixes": op1_suffixes,
        "op2_pieces": op2_pieces,
        "op3_licenses": op3_licenses,
        "op4_spots": op4_spots,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_language": op6_language,
        "op7_warc": op7_warc,
        "op8_top_k": op8_top_k,
        "op9_packing": op9_packing,
        "op10_lines": op10_lines,
        "op11_alignment": op11_alignment,
        "op12_resampling": op12_resampling,
        "op13_recurrent": op13_recurrent,
    }


def oracles() -> dict[str, str]:
    return {"op7_warc": OP7_SQL, "op8_top_k": OP8_SQL, "op10_lines": OP10_SQL}
