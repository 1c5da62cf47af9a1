import math
import random

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import toxicity
from holdfast.llm.queries import op8_toxicity_chain

BAD = ("scoundrel", "rascal", "vermin")


def corpus(seed=0, rows=900):
    rng = random.Random(seed)
    out, labels = [], []
    for i in range(rows):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 80))]
        toxic, junk = i % 7 == 0, i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        out.append((i, " ".join(words) + ("$$$" if junk else "")))
        labels.append((i, int(not junk), int(toxic)))
    return out, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_statistic_against_the_formula():
    table = np.array([[30, 5], [70, 95]], float)
    total, want = table.sum(), 0.0
    for i in range(2):
        for j in range(2):
            want += 2 * table[i, j] * math.log(table[i, j] * total / (table[i].sum() * table[:, j].sum()))
    got = toxicity.statistic(np.array([35.0]), np.array([30.0]), 200, 100)
    assert abs(got[0] - want) < 1e-9


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    models = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    told = toxicity.classify(docs.join(labels, "doc_id"), models).filter("doc_id % 2 = 1").collect()
    assert all((r.toxicity.toxic >= 0.5) == (r.toxic == 1) for r in told)
    assert np.mean([(r.toxicity.junk >= 0.5) == (r.quality == 0) for r in told]) > 0.99
    assert np.mean([(r.toxicity.toxic_prose >= 0.5) == (r.toxic == 1 and r.quality == 1) for r in told]) > 0.97
    assert [len(m.before) for m in models] == [0, 1, 2]


def test_earlier_odds_reach_later_models():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400).astype(float)
    model = toxicity.fit(pa.array([[] for _ in y], pa.list_(pa.int32())), (4 * y - 2 + rng.normal(size=400))[:, None], y)
    assert model.before[0] > 0.5 and model.words == {}


def test_bounded_sample_trains_copies_once(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(50)] + [(100 + i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(150)] + [(3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.labelled_sample(docs, labels, toxicity.CATEGORIES).collect()
    assert len(rows) == 51
    assert toxicity.labelled_sample(docs, labels, toxicity.CATEGORIES, sample=20).count() <= 20


def test_awkward_rows(spark, awkward, nothing, tables):
    labels = tables[1]
    models = toxicity.train(awkward, labels)
    told = toxicity.classify(awkward, models)
    assert told.columns == [*awkward.columns, "toxicity"] and told.count() == awkward.count()
    none = spark.createDataFrame([], labels.schema)
    assert toxicity.classify(nothing, toxicity.train(nothing, none)).count() == 0
    assert toxicity.clean_documents(awkward, none).columns == awkward.columns


def test_without_a_training_row_every_document_stays(spark, tables):
    docs, labels = tables
    others = labels.selectExpr("doc_id + 10000 as doc_id", "quality", "toxic")
    unknown = labels.selectExpr("doc_id", "quality", "cast(null as int) as toxic")
    for none in (labels.filter("false"), others, unknown):
        assert toxicity.clean_documents(docs, none).count() == docs.count()
    told = toxicity.classify(docs, toxicity.train(docs, unknown)).first().toxicity
    assert told.toxic is None and told.junk is not None


def test_labels_of_other_documents_take_no_place_in_the_sample(spark, tables):
    docs, labels = tables
    others = labels.selectExpr("doc_id + 10000 as doc_id", "quality", "toxic")
    rows = toxicity.labelled_sample(docs.filter("doc_id < 50"), labels.unionByName(others), toxicity.CATEGORIES, sample=50)
    assert rows.count() == 50


def test_query_against_labels(spark, sf):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op8_toxicity_chain(spark, sf).collect()
    told = [(r.toxic, toxic[r.doc_id]) for r in rows if r.doc_id in toxic]
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert np.mean([a == (b == 1) for a, b in told]) > 0.85


def test_columns_named_as_those_used_inside(spark, tables):
    docs, labels = tables
    names = ["_text", "__text", "toxicity", "_toxicity", "TOXIC", "row", "key", "words", "before"]
    clashing = docs.selectExpr("*", *[f"doc_id as `{n}`" for n in names])
    got = toxicity.clean_documents(clashing, labels)
    assert got.columns == clashing.columns
    want = {r.doc_id for r in toxicity.clean_documents(docs, labels).select("doc_id").collect()}
    rows = got.collect()
    assert {r.doc_id for r in rows} == want and all(r[n] == r.doc_id for r in rows for n in names)
