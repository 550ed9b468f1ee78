"""A corpus pipeline: each stage applies one operator of ``tidemill.llm`` to all that the
stage before it kept. All but the last return the columns of ``documents``.

Rows with a null doc_id go through every stage. Texts that are null are scored, mixed and
encoded as empty ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.bpe import encode_bpe
from tidemill.llm.common import saved, table
from tidemill.llm.lines import dedup_lines
from tidemill.llm.mixing import mix_sources, take_copies
from tidemill.llm.ordermin import near_duplicates
from tidemill.llm.quality import score_quality, train
from tidemill.llm.queries import VOCABULARY

LEAST_SCORE = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, out="_score")
    return scored.where(F.col("_score") >= LEAST_SCORE).select(*docs.columns)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; documents stay, if need be with an empty text."""
    cut = dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest doc_id."""
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    named = docs.join(kept.where("doc_id is not null"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.union(docs.where("doc_id is null")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not, once or twice."""
    return take_copies(docs, mix_sources(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and the text they decode to."""
    encoded = encode_bpe(docs.select("doc_id", "lang", "source", "text"), VOCABULARY, decoded="decoded")
    return encoded.drop("text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("line dedup", cut_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("mixing", mix),
    ("bpe", tokenize),
]
ORACLE_SQL: str | None = None  # a model, chunk limits, sketches and merges are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
