"""The queries of this subpackage, one for each operator, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.bpe import decode_bpe, encode_bpe
from tidemill.llm.common import table
from tidemill.llm.hardneg import hard_negatives
from tidemill.llm.lines import dedup_lines
from tidemill.llm.maintext import extract_main_text
from tidemill.llm.maintext import train as train_regions
from tidemill.llm.mixing import mix_sources
from tidemill.llm.ordermin import near_duplicates
from tidemill.llm.pitmanyor import score_texts
from tidemill.llm.quality import held_out, score_quality, train
from tidemill.llm.runindex import remove_repeats
from tidemill.llm.search import rank_documents
from tidemill.llm.subspace import linked_vectors
from tidemill.llm.warc import page_of, page_records, read_warc, write_warc
from tidemill.llm.winnow import neighbour_likeness
from tidemill.session import scratch_dir

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def sha256(text: str) -> F.Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def op1_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(documents).select("doc_id", "n_lines", "n_removed", "text")


def op2_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x.high - x.low)
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n_links", "component_id", "kept"
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_likeness(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", sha256("edited").alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = scratch_dir(spark, "warc")
    write_warc(page_records(table(spark, sf_dir, "pages")), archives)
    responses = read_warc(spark, archives).where("record_type = 'response'").select(
        page_of("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = read_warc(spark, archives, payload=False).where("record_type = 'revisit'").select(
        page_of("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.expr("substring_index(payload_digest, ':', -1)").alias("payload_digest"), "record_type",
        page_of("refers_to").alias("refers_to"),
    )
    return responses.union(revisits)


OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
l AS (SELECT payload_digest, max(page_id) AS latest FROM h WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, h.payload_digest,
  CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM h LEFT JOIN l ON h.payload_digest = l.payload_digest AND payload_bytes >= 1000
"""


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_bpe(documents, VOCABULARY).select("doc_id", "ids")
    return decode_bpe(encoded, VOCABULARY).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias(
            "ids_sha256"
        ),
        sha256("decoded").alias("decoded_sha256"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    return score_quality(documents, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages, train_regions(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", noisy), F.col("key") % 50 == 0)


OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def op12_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string")) % 7
    scored = score_texts(documents, rest != 2)
    return scored.select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op13_document_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERM_LIST = (
    "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
)
OP13 = f"""
WITH t AS (SELECT doc_id, {TERM_LIST} FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM n),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM f, a GROUP BY term, docs),
q AS (SELECT item_id, {TERM_LIST} FROM benchmark),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (doc_id), a GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_chunks": op1_line_chunks,
    "op2_run_index": op2_run_index,
    "op3_order_minhash": op3_order_minhash,
    "op4_subspace_join": op4_subspace_join,
    "op5_mixing": op5_mixing,
    "op6_winnowing": op6_winnowing,
    "op7_warc": op7_warc,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_main_text": op10_main_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pitman_yor": op12_pitman_yor,
    "op13_document_tree": op13_document_tree,
}
ORACLES: dict[str, str] = {"op7_warc": OP7, "op11_hard_negatives": OP11, "op13_document_tree": OP13}
