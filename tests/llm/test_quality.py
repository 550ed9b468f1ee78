import random
import zlib

import numpy as np
import zstandard

from tests.llm.cases import documents, lines, odd_rows, words
from tidemill.llm import quality
from tidemill.llm.quality import Describer, fit, held_out, score_quality, train


def corpus(n=400):
    """Good prose, and junk of four kinds."""
    junk = (
        lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", "$$$ "), lambda t: t.replace(" ", " | "),
        lambda t: " ".join(w for w in t.split()[:6] for _ in range(15)),
    )
    rows, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        text = lines(i, 3 + i % 7)
        rows.append((i, text if good else junk[i // 5 % 4](text)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = score_quality(docs, train(docs, known)).select("doc_id", held_out().alias("h"), "score").collect()
    truth = {i: q for i, q, _ in labels}
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r.h]
    assert len(out) > 50
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in out]) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = corpus(120)
    docs = documents(spark, rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    models = [train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned)]
    assert np.array_equal(models[0].labels, models[1].labels)
    assert np.array_equal(models[0].vectors, models[1].vectors)


def test_the_ratio_of_labels_does_not_change_with_the_size(spark, monkeypatch):
    rows = [(i, words(i, 6)) for i in range(6000)]
    labels = spark.createDataFrame([(i, int(i % 2 > 0 or i % 3 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows).coalesce(4).cache()
    monkeypatch.setattr(quality, "fit", lambda terms, known: known)
    open_ = [int(i % 6 > 0) for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    known = train(docs, labels)
    assert len(known) == 4000 < len(open_)
    assert abs(np.mean(known) - np.mean(open_)) < 0.01
    few = train(docs, labels.where("doc_id < 1200"))
    assert len(few) < 1000 and abs(np.mean(few) - np.mean(known)) < 0.02


def test_vocabulary_alone_tells_texts_apart(spark):
    """Words of the same lengths in the same form; only which words they are differs."""
    draw = random.Random(6)
    vocabulary = [["".join(draw.choice("abcdefghijklmnop") for _ in range(n % 7 + 2)) for n in range(150)] for _ in range(2)]
    rows, labels = [], []
    for i in range(900):
        good = i % 2
        pick = [draw.randrange(150) for _ in range(draw.randint(30, 120))]
        rows.append((i, " ".join(vocabulary[good if draw.random() < 0.7 else 1 - good][k] for k in pick)))
        labels.append((i, good, 0))
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = score_quality(docs, train(docs, known)).where(held_out()).select("doc_id", "score").collect()
    good, bad = ([r.score for r in got if r.doc_id % 2 == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95


def test_one_row_for_each_key(spark, monkeypatch):
    monkeypatch.setattr(quality, "fit", lambda terms, known: (terms, known))
    rows = [(i, words(i, 5)) for i in range(40)] * 2 + [(i, words(900 + i, 5)) for i in range(40)]
    labels = [(i, y, 0) for i in range(40) for y in (1, i % 2)] * 2
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    terms, y = train(docs, known)
    open_ = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert len(terms) == len(y) == len(open_) and y.sum() == sum(i % 2 for i in open_)
    again = train(docs.repartition(7), known.repartition(5))
    assert np.array_equal(terms, again[0]) and np.array_equal(y, again[1])


def test_the_sample_reaches_the_driver_packed(spark, monkeypatch):
    """Rows of terms are mostly 0: whole, they would fill the driver's memory."""
    taken = {}
    monkeypatch.setattr(quality, "fit", lambda terms, known: taken.update(terms=terms, known=known))
    rows, labels = corpus(60)
    train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    terms = taken["terms"]
    assert sum(map(len, terms.rows)) < 0.5 * 4 * quality.TERMS * len(terms)
    texts = {Describer()(t).tobytes() for i, t in rows if zlib.crc32(str(i).encode()) % 5}
    assert {x.tobytes() for x in terms[:]} == texts


def test_blocks_change_no_bit(monkeypatch):
    rows, labels = corpus(150)
    terms = np.stack([Describer()(t) for _, t in rows])
    y = np.array([q for _, q, _ in labels], np.float32)
    packed = quality.Packed([zstandard.ZstdCompressor().compress(x.tobytes()) for x in terms])
    whole, again = fit(terms, y), fit(packed, y)
    assert np.array_equal(whole.vectors, again.vectors) and np.array_equal(whole.basis, again.basis)
    mean = (terms.mean(0) * whole.weight).astype(np.float32)
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert np.array_equal(fit(packed, y).mean, mean)


def test_votes_are_those_of_brute_force():
    rows, labels = corpus(150)
    terms = np.stack([Describer()(t) for _, t in rows])
    y = np.array([q for _, q, _ in labels], np.float32)
    model = fit(terms[:100], y[:100])
    for x, score in zip(terms[100:], model.score(terms[100:])):
        cosine = model.vectors @ model.project(x[None])[0]
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        vote = np.maximum(cosine[near], 0)
        assert abs(score - (vote @ y[:100][near]) / vote.sum()) < 1e-5


def test_odd_rows(spark):
    rows, labels = corpus(60)
    docs = documents(spark, odd_rows())
    model = train(documents(spark, rows), spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int"))
    scored = score_quality(docs, model, out="value")
    assert sorted(scored.columns) == sorted(docs.columns)
    got = scored.select("doc_id", "text", "value").collect()
    assert len(got) == len(odd_rows())
    assert all(0 <= r.value <= 1 for r in got)
    assert all(r.value == model.prior for r in got if not (r.text or "").strip())
    assert {r.h for r in docs.where("doc_id is null").select(held_out().alias("h")).collect()} == {False}


def test_nothing_labelled_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, words(1, 5))])
    model = train(docs, none)
    assert [r.score for r in score_quality(docs, model).collect()] == [0.5]
    assert score_quality(docs.limit(0), model).count() == 0
