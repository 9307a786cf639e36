"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kneser_ney, merkle, variants
from .common import materialize
from .exact_dedup import exact_dedup
from .jaccard import jaccard_join
from .line_dedup import line_dedup
from .mixing import mix_sources
from .neardup import near_duplicates
from .packing import pack
from .quality import classify_quality
from .sharding import shard_by_bytes
from .substring import substring_dedup
from .token_counts import token_prefixes


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(docs_of(spark, sf_dir), carry={"text_sha256": F.sha2("_norm", 256)})


def tokenizer() -> tuple[str, str]:
    """The byte-level BPE of the public tokenizers: path of its ranks and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(docs_of(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir).select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"))
    model = kneser_ney.train(docs.where("NOT held_out"))
    scored = materialize(kneser_ney.score(docs, model), "scores")  # written in batches by bytes
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(docs_of(spark, sf_dir))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    sizes = materialize(docs_of(spark, sf_dir).select("doc_id", "source", size.alias("size")), "sizes")
    return mix_sources(sizes, "size")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(docs_of(spark, sf_dir), *tokenizer())


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(docs_of(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    sized = docs_of(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_by_bytes(sized, "size", 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(docs_of(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.digest(*[F.col(c) for c in columns[:-1]], lowered))
    rows = merkle.manifest(docs_of(spark, sf_dir), columns, "lang", "doc_id", carry={"tampered": changed})
    rows = rows.withColumn("proof_sha256", merkle.proof_sha256(F.col("path"))).withColumn("folded_root", merkle.folded_root(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    word, doc = F.col("_word"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.crc32(F.concat(doc, F.lit(":"), word))
    at = (h % F.char_length(word)).cast("int")
    cut = F.when(h % 31 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))).otherwise(word)
    words = variants.word_counts(docs_of(spark, sf_dir).select("doc_id", "text"), F.col("text"), 7, 2, cut)
    return variants.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_prefixes(docs_of(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sharding": op9_sharding,
    "op10_line_dedup": op10_line_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_counts": op13_token_counts,
}

#: The crc32 of a text, a framed value and a text with A-Z lower-cased, for SQL that has none of them: expressions over {0}.
_FRAMED = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode({0}))), lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))))"""


def _expanded(sql: str) -> str:
    """SQL with calls crc(x), framed(x) and ascii_lower(x) replaced by what they stand for; the innermost first."""
    for name, body in (("ascii_lower", _LOWER), ("framed", _FRAMED), ("crc", _CRC32)):
        while f"{name}(" in sql:
            start = sql.index(f"{name}(")
            end, depth = start + len(name) + 1, 1
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[end], 0)
                end += 1
            sql = sql[:start] + body.replace("{0}", sql[start + len(name) + 1 : end - 1]) + sql[end:]
    return sql


ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
             h AS (SELECT doc_id, sha256(t) AS s FROM n),
             g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY s)
        SELECT h.doc_id, g.keep_id, g.group_size, h.doc_id = g.keep_id AS kept, h.s AS text_sha256 FROM h JOIN g USING (s)""",
    "op10_line_dedup": r"""
        WITH l AS (SELECT doc_id, line, pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents) d,
                   LATERAL (SELECT unnest(a) AS line, generate_subscripts(a, 1) AS pos) x),
             k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
             o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
             m AS (SELECT k.*, o.owner IS NOT NULL AND k.doc_id > o.owner AS gone FROM k LEFT JOIN o ON k.key = o.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id""",
    "op11_merkle_manifest": _expanded(r"""
        WITH RECURSIVE f AS (SELECT doc_id, lang, framed(CAST(doc_id AS VARCHAR)) || framed(source) || framed(lang) || framed(CAST(n_chars AS VARCHAR)) AS head, text FROM documents),
             leaves AS (SELECT doc_id, lang, sha256(head || framed(text)) AS leaf,
                               CASE WHEN crc(CAST(doc_id AS VARCHAR)) % 3 = 0 THEN sha256(head || framed(ascii_lower(text))) ELSE sha256(head || framed(text)) END AS now FROM f),
             placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
             low(g, k, pos, h, n) AS (
                 SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM placed
                 UNION ALL
                 SELECT g, k + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY g, k, pos // 8, n),
             subs AS (SELECT g, h, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS pos FROM low WHERE n = 1),
             top(k, pos, h, n) AS (
                 SELECT 0, pos, h, count(*) OVER () FROM subs
                 UNION ALL
                 SELECT k + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY k, pos // 8, n),
             nodes AS (SELECT g, k, pos, h, n FROM low WHERE n > 1),
             walk AS (SELECT p.doc_id, p.lang, p.leaf, p.now, 0 AS part, w.k, p.pos // CAST(power(8, w.k) AS BIGINT) AS at FROM placed p JOIN (SELECT DISTINCT g, k FROM nodes) w ON w.g IS NOT DISTINCT FROM p.lang
                      UNION ALL
                      SELECT p.doc_id, p.lang, p.leaf, p.now, 1, w.k, s.pos // CAST(power(8, w.k) AS BIGINT) FROM placed p JOIN subs s ON s.g IS NOT DISTINCT FROM p.lang CROSS JOIN (SELECT DISTINCT k FROM top WHERE n > 1) w),
             every AS (SELECT 0 AS part, g, k, pos, h FROM nodes UNION ALL SELECT 1, NULL, k, pos, h FROM top WHERE n > 1),
             steps AS (SELECT w.doc_id, w.leaf, w.now, w.part, w.k, coalesce(string_agg(e.h, '' ORDER BY e.pos) FILTER (WHERE e.pos < w.at), '') AS l, coalesce(string_agg(e.h, '' ORDER BY e.pos) FILTER (WHERE e.pos > w.at), '') AS r
                       FROM walk w JOIN every e ON e.part = w.part AND e.k = w.k AND e.pos // 8 = w.at // 8 AND (w.part = 1 OR e.g IS NOT DISTINCT FROM w.lang) GROUP BY ALL),
             paths AS (SELECT doc_id, leaf, now, string_agg(l || r, '' ORDER BY part, k) AS sib, list({'l': l, 'r': r} ORDER BY part, k) AS p FROM steps GROUP BY ALL),
             fold(doc_id, leaf, node, i, p) AS (
                 SELECT p.doc_id, p.leaf, p.now, 0, coalesce(q.p, []) FROM placed p LEFT JOIN paths q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
                 UNION ALL
                 SELECT doc_id, leaf, sha256(p[i + 1].l || node || p[i + 1].r), i + 1, p FROM fold WHERE i < len(p))
        SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(q.sib, '')) AS proof_sha256, f.node AS folded_root, f.node = t.h AS verified
        FROM placed p JOIN subs s ON s.g IS NOT DISTINCT FROM p.lang CROSS JOIN (SELECT h FROM top WHERE n = 1) t
        LEFT JOIN paths q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
        JOIN fold f ON f.doc_id IS NOT DISTINCT FROM p.doc_id AND f.leaf = p.leaf AND f.i = len(f.p)"""),
    "op12_spelling_variants": _expanded(r"""
        WITH RECURSIVE runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS r FROM documents),
             o AS (SELECT id, ascii_lower(r) AS w, count(*) AS n FROM runs GROUP BY ALL),
             hashed AS (SELECT w, n, crc(id || ':' || w) AS h FROM o),
             changed AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
             words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
             cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
             near AS (SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
                      UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.rest
                      UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest),
             ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(near)) AS k FROM near),
             forms AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1),
             chain(word, last) AS (SELECT word, word FROM words UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
             roots AS (SELECT c.word, c.last FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NULL)
        SELECT f.word, f.form, r.last AS root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word"""),
}
