import sentencepiece

import corpus_pipeline
from holdfast.llm import decontaminate, pieces
from holdfast.llm.common import folded_words
from holdfast.llm.queries import ORACLE, QUERIES
from test_simhash import brute_components, brute_fingerprint


def test_stages_drop_and_keep_what_their_operators_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before, left = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        left.append({r.doc_id: r.text for r in after.collect()})
        before = spark.createDataFrame(after.collect(), docs.schema)
    good, civil, distinct, unseen = left
    assert not [i for i in good if labels.get(i, (1, 0))[0] == 0]
    assert set(unseen) <= set(distinct) <= set(civil) <= set(good)
    # the smallest id of each component stays, so no two of those left link
    marks = [(i, brute_fingerprint(t)) for i, t in sorted(civil.items())]
    assert set(distinct) == set(brute_components(marks, lambda a, b: (a ^ b).bit_count() <= 4))
    assert len(distinct) < len(civil)
    items = [[w for w in folded_words(r.text.encode())] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9))}
    for i, text in distinct.items():
        words = folded_words(text.encode())
        held = any(tuple(words[a : a + 10]) in windows for a in range(max(0, len(words) - 9)))
        assert held == (i not in unseen)
    assert decontaminate.WINDOW == 10


def test_run_over_the_table(spark, sf):
    rows = QUERIES["pipeline"](spark, sf).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path(pieces.MODEL))
    assert rows and all(r.round_trip and r.ids == library.encode(r.text) and r.n_ids == len(r.ids) for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_last_stage_gives_way_to_no_given_column(spark, sf, nothing):
    given = spark.createDataFrame([(1, "a text", "x", 2, "y"), (2, None, "x", 2, "y")], "doc_id long, text string, ids string, n_ids int, decoded string")
    rows = corpus_pipeline.encoded(spark, given, sf).orderBy("doc_id").collect()
    assert [(r.decoded, r.n_ids, r.round_trip) for r in rows] == [("y", len(rows[0].ids), True), ("y", 0, True)]
    assert all(stage(spark, nothing, sf).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_every_operator_has_its_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10
    assert set(ORACLE) <= set(QUERIES)
