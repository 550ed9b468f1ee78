"""The registered queries over the small tables, and the pipeline on made-up rows."""

import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import connect, difference
from tests.llm.cases import documents, lines, words
from tidemill.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1": "doc_id text", "op2": "doc_id n_bytes n_removed n_spans kept_sha256", "op3": "doc_id class_id kept",
    "op4": "vec_id n_links component_id kept", "op5": "doc_id size source_size target taken",
    "op6": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op7": "page_id payload_bytes payload_digest record_type refers_to",
    "op8": "doc_id n_tokens ids_sha256 decoded_sha256", "op9": "doc_id held_out score predicted",
    "op10": "page_id url text n_chars",
    "op11": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12": "doc_id held_out n_tokens n_known train_tokens base_score score", "op13": "item_id rank doc_id score",
}
TABLE = {"op4": "embeddings", "op7": "pages", "op10": "pages"}
SEARCHES = ("op11", "op13")  # rows of these are results, not those of a table


def test_one_query_for_each_operator():
    assert [n.partition("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_every_row_of_the_table(name, spark, small_sf):
    op = name.partition("_")[0]
    got = QUERIES[name](spark, small_sf)
    assert set(COLUMNS[op].split()) <= set(got.columns)
    if op in SEARCHES:
        return
    key = COLUMNS[op].split()[0]
    given = spark.read.parquet(f"{small_sf}/{TABLE.get(op, 'documents')}.parquet")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


@pytest.mark.parametrize("name", ORACLES)
def test_sql(name, spark, small_sf):
    assert difference(QUERIES[name](spark, small_sf), connect(small_sf), ORACLES[name]) == ""


def test_pipeline(spark, tmp_path):
    passage = lines(1, 30)
    rows = [(i, lines(i, 4) + "\n" + words(i, 60), "ab"[i % 2]) for i in range(100, 140)]
    rows += [(1, passage, "a"), (2, words(9, 30) + "\n" + words(8, 20) + "\n" + passage, "b")]
    rows += [(3, rows[0][1] + " end", "a"), (4, words(4, 80).upper().replace(" ", "!! "), "a"), (5, None, None), (None, words(5, 50), "a")]
    known = [(i, 1, 0) for i in range(100, 140)] + [(i, 0, 0) for i in range(200, 240)]
    rows += [(i, words(i, 70).upper().replace(" ", "!! "), "b") for i in range(200, 240)]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = []
    at = docs
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(path := f"{tmp_path}/{len(stages)}")
        at = spark.read.parquet(path)
        stages.append({(r.doc_id, r.text if "text" in r else None) for r in at.collect()})
        if len(stages) < 5:
            assert at.columns == docs.columns
    ids = [{k for k, _ in s} for s in stages]
    assert ids[0] == {1, 2, 3, 5, None, *range(100, 140)}  # junk goes, prose stays
    assert ids[1] == ids[0]
    texts = dict(stages[1])
    assert texts[1] == passage and len(texts[2]) < len(dict(stages[0])[2])
    assert ids[1] - ids[2] == {100}  # a near copy of 3
    assert ids[3] <= ids[2] and ids[4] == ids[3]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, at.collect()))
    assert all(re.fullmatch(r"(\S+ ?)*", r.decoded) for r in at.collect())
