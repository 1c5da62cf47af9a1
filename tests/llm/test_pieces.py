import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import pieces, token_counts
from holdfast.llm.queries import op7_piece_ids, op9_token_counts

PATH = pieces.model_path(pieces.MODEL)
COUNTS = token_counts.Counts(PATH, {"the": 1})
ANY_TEXT = st.text("ab  \n\tetheinsr.,!é中▁\x00<s>/[]①😀", max_size=60) | st.text(max_size=30)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(ANY_TEXT)
def test_ids_are_the_librarys_and_decode_to_the_text(library, text):
    ids = pieces.encoder(PATH).encode(text)
    assert ids.tolist() == library.encode(text)
    assert pieces.vocabulary(PATH).decode(ids) == text.replace(pieces.SPACE, " ")


@settings(max_examples=300, deadline=None)
@given(ANY_TEXT)
def test_counts_are_the_librarys(library, text):
    assert COUNTS.of(text) == len(library.encode(text))


def test_the_window_stays_small_and_paths_are_given_out_early(library):
    text = "a" * 3000 + "the" * 500
    lattice = pieces.encoder(PATH).lattice
    search, ids, widest = pieces.Search(lattice), [], 0
    for char in text:
        for run in search.read(char):
            ids += run
        widest = max(widest, len(search.paths))
    ids += search.rest()
    plain = [i for run in lattice.ids(text) for i in run]
    assert ids == plain == library.encode("\n" + text)[2:]
    assert widest <= 5 * lattice.longest


def best_by_force(text, scores):
    """The heaviest way to cut ``text`` into pieces, by trying all of them."""
    best = {0: (0.0, [])}
    for end in range(1, len(text) + 1):
        for start in range(end):
            if start in best and text[start:end] in scores:
                weight = best[start][0] + scores[text[start:end]]
                if end not in best or weight > best[end][0]:
                    best[end] = (weight, [*best[start][1], text[start:end]])
    return best[len(text)][0]


@settings(max_examples=100, deadline=None)
@given(st.text("abc", min_size=1, max_size=40))
def test_a_unigram_models_heaviest_path(text):
    scores = {"a": -1.5, "b": -2.5, "c": -3.5, "ab": -2.25, "bc": -4.5, "abc": -3.25, "ca": -4.0, "aab": -3.75, "bca": -5.25}
    names = list(scores)
    lattice = pieces.Lattice({p: (i, s) for i, (p, s) in enumerate(scores.items())}, [0] * 256, merges=False)
    got = [names[i] for run in lattice.ids(text) for i in run]
    assert "".join(got) == text
    assert sum(scores[p] for p in got) == pytest.approx(best_by_force(text, scores))


def test_caches_do_not_change_ids(library):
    own = pieces.Encoder(PATH, kept_bytes=16_000)
    assert own.beginnings == 1 and own.lattice.pairs == 31
    text = " ".join(f"w{i % 37}thing{i % 11}, on" for i in range(400))
    assert own.encode(text).tolist() == library.encode(text) == own.encode(text).tolist()
    # the two generations of words stay within their bytes
    held = [sum(pieces.WORD_BYTES + 4 * len(k) + len(v) for k, v in kept.items()) for kept in (own.known, own.older)]
    assert held[0] == own.known_size and 0 < max(held) <= own.word_bytes


def test_query_against_the_library(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_piece_ids(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.ids == library.encode(docs[r.doc_id]) and r.n_ids == len(r.ids) and r.round_trip


def test_counts_query_against_the_library(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_token_counts(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(library.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_awkward_rows(awkward, nothing, library):
    for both in (pieces.decode(pieces.encode(awkward)), pieces.encode(awkward, decoded="decoded")):
        assert both.columns == [*awkward.columns, "ids", "decoded"]
        for r in both.collect():
            text = r.text or ""
            assert r.ids == library.encode(text) and r.decoded == text.replace(pieces.SPACE, " ")
    assert pieces.decode(pieces.encode(nothing)).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(awkward, ids="key")


def test_awkward_counts(awkward, nothing, library):
    counted = token_counts.count_tokens(awkward, keep=3)
    assert counted.columns == [*awkward.columns, "n_tokens"]
    for r in counted.collect():
        assert r.n_tokens == len(library.encode(r.text or ""))
    assert token_counts.count_tokens(nothing).count() == 0
    clash = awkward.withColumnRenamed("key", "_text").withColumnRenamed("row", "__text")
    assert {(r["_text"], r["__text"]) for r in token_counts.count_tokens(clash).collect()} == {(r["key"], r["row"]) for r in awkward.collect()}


def test_frequent_words_are_bounded_and_counted(spark):
    df = spark.createDataFrame([("the cat the dog the end",)] * 50, "text string").repartition(7)
    rows = token_counts.frequent(df, keep=2).collect()
    assert [(r.key, r.n) for r in rows] == [("the", 150), ("cat", 50)]


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(None,), ([],), ([1, 2],)], "ids array<int>")
    assert [r.decoded for r in pieces.decode(df).collect()] == ["", "", ""]
    assert pieces.vocabulary(PATH).decode(np.array([], np.int32)) == ""
