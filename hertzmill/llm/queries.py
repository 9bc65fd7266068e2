"""Registered queries of the training-data operators: thin contracts over each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .chat import format_conversations, read_back
from .embeddings import near_duplicates
from .fingerprints import fingerprints
from .html import extract
from .jaccard import jaccard_components
from .language import fit, identify
from .manifest import manifest, proof_digest
from .mixing import mix
from .packing import pack
from .passages import repeated_passages
from .quality import judge
from .warc import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 6).alias("posterior"), "votes")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang").dropna())
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(format_conversations(rows))
    learnt = F.array_join(F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: x["text"]), "")
    told_back = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told_back, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = manifest(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


ORACLES = {
    "op5_chat_format": r"""
WITH c AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, '### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE role END || ': '
             || replace(replace(replace(text, '\', '\\'), '#', '\h'), '<', '\l') || '</turn>' || chr(10) AS shown FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(shown)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""",
    "op6_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^ \t-\r]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS z FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
o AS (SELECT *, COALESCE(sum(2.0 * z) OVER before, 0) AS capped, sum(weight) OVER () - COALESCE(sum(weight) OVER before, 0) AS rest
      FROM w WINDOW before AS (ORDER BY 2.0 * z / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, (1.5 * (SELECT sum(z) FROM s) - capped) / rest AS rate FROM o),
f AS (SELECT arg_min(rate, 2.0 * z / weight) FILTER (2.0 * z > rate * weight) AS rate FROM r),
t AS (SELECT source, z, CASE WHEN 2.0 * z <= f.rate * weight THEN CAST(2.0 * z AS DOUBLE) ELSE CAST(f.rate * weight AS DOUBLE) END AS target FROM r, f),
k AS (SELECT *, CASE WHEN z > 0 THEN CAST(floor(target / z) AS BIGINT) ELSE 0 END AS times FROM t),
c AS (SELECT d.doc_id, d.size, k.z, k.target, k.times, k.target - k.times * k.z AS budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, h) AS own
      FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, z AS source_size, target, CAST(size * (times + CASE WHEN budget - (upto - own) >= own / 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
""",
}

ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, strlen(COALESCE(html, '')) AS n, sha1(COALESCE(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to FROM m
"""

ORACLES["op4_embedding_neardup"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
r AS (SELECT vec_id, vec_id AS seen FROM v UNION SELECT r.vec_id, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT vec_id, min(seen) AS component_id FROM r GROUP BY vec_id), n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT c.vec_id, COALESCE(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.vec_id
"""

#: CRC-32 by bits, least first: the polynomial is the reversed one of the standard.
ORACLES["op11_merkle_manifest"] = """
WITH RECURSIVE f AS (
  SELECT doc_id, source, text, concat_ws('', COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), COALESCE(strlen(source) || ':' || source, '-'),
         COALESCE(strlen(lang) || ':' || lang, '-'), COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
         list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: list_transform(range(8), lambda i: (ascii(x) >> i) & 1)))),
                     lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)) AS crc FROM documents),
d AS (SELECT doc_id, source, sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || COALESCE(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS altered FROM f),
a AS (SELECT *, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM d WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
t AS (SELECT source, 0 AS k, CAST(r AS BIGINT) AS i, n, leaf AS h FROM a
      UNION ALL SELECT source, k + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY source, k, i // 3),
s AS (SELECT source, k AS top, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS k, CAST(r AS BIGINT) AS i, n, subroot AS h FROM s
      UNION ALL SELECT k + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY k, i // 3),
root AS (SELECT h AS root FROM u WHERE n = 1),
x AS (SELECT doc_id, leaf, COALESCE(altered, leaf) AS start, a.source, a.r, s.subroot, s.r AS s_r, s.top FROM a JOIN s ON a.source IS NOT DISTINCT FROM s.source),
w AS (SELECT row_number() OVER () AS id, * FROM x),
p AS (SELECT id, t.k, string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < w.r // pow3.p) AS l, string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > w.r // pow3.p) AS g
      FROM w JOIN (SELECT k, CAST(pow(3, k) AS BIGINT) AS p FROM range(40) z(k)) pow3 ON pow3.k < w.top
      JOIN t ON t.source IS NOT DISTINCT FROM w.source AND t.k = pow3.k AND t.i // 3 = w.r // (3 * pow3.p) GROUP BY id, t.k
      UNION ALL
      SELECT id, w.top + u.k, string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < w.s_r // pow3.p), string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > w.s_r // pow3.p)
      FROM w JOIN (SELECT k, CAST(pow(3, k) AS BIGINT) AS p FROM range(40) z(k)) pow3 ON pow3.k < (SELECT max(k) FROM u)
      JOIN u ON u.k = pow3.k AND u.i // 3 = w.s_r // (3 * pow3.p) GROUP BY id, w.top, u.k),
e AS (SELECT id, sha256(COALESCE(string_agg(COALESCE(l, '') || COALESCE(g, ''), '' ORDER BY k), '')) AS proof_sha256 FROM w LEFT JOIN p USING (id) GROUP BY id),
c AS (SELECT id, 0 AS k, start AS h FROM w UNION ALL SELECT c.id, c.k + 1, sha256(COALESCE(l, '') || h || COALESCE(g, '')) FROM c JOIN p ON p.id = c.id AND p.k = c.k),
v AS (SELECT id, arg_max(h, k) AS folded_root FROM c GROUP BY id)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM w JOIN e USING (id) JOIN v USING (id), root
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
