import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import decontaminate
from holdfast.llm.common import folded_words
from holdfast.llm.queries import op10_benchmark_windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(folded)


def brute(text, items, window=10):
    words, hit, names = words_of(text), set(), set()
    for name, body in items:
        own = words_of(body)
        size = min(window, len(own))
        for s in range(len(own) - size + 1) if own else ():
            for a in range(len(words) - size + 1):
                if words[a : a + size] == own[s : s + size]:
                    hit |= set(range(a, a + size))
                    if name is not None:
                        names.add(str(name))
    return len(words), len(hit), sorted(names)


def found(df, items, **options):
    rows = decontaminate.contamination(df, items, **options).collect()
    return [(r.contamination.n_words, sum(s.end - s.start for s in r.contamination.spans), r.contamination.items) for r in rows], rows


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_words(text):
    assert [w.decode() for w in folded_words(text.encode())] == words_of(text)


def test_planted_passages_of_all_kinds(spark):
    rng = random.Random(2)
    vocabulary = ["the", "of", "a", *(f"w{i}" for i in range(30))]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([3, 9, 10, 11, 25]))) for i in range(30)]
    items += [(30, items[0][1]), (None, say(12)), (31, None), (32, "  ...  "), (33, "the the the the the the the the the the the the")]
    docs = []
    for i in range(60):
        body = say(rng.choice([0, 1, 5, 40, 200])).split()
        if i % 2:
            passage = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, len(body))
            body[cut:cut] = [w.upper() + "," for w in passage[: rng.randint(0, len(passage))]]
        docs.append((i, " ".join(body)))
    docs += [(60, None), (61, ""), (62, "the " * 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as items", "1 as n_words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [brute(t, items) for _, t in docs]
    for block in (decontaminate.BLOCK_WINDOWS, 40):
        assert found(df, bench, block_windows=block)[0] == want
    clean = decontaminate.clean_documents(df, bench)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for (i, _), w in zip(docs, want) if not w[1]]


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "long long"), (2, "the cat sat on")], "item_id long, text string")
    got, rows = found(awkward, items)
    assert got == [brute(r.text, [(1, "long long"), (2, "the cat sat on")]) for r in rows]
    none = spark.createDataFrame([], items.schema)
    assert all(g[1:] == (0, []) for g in found(awkward, none)[0])
    assert found(nothing, items)[0] == []


def test_query_against_brute_force(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in op10_benchmark_windows(spark, sf).collect()}
    planted = [r for r in rows.values() if r.contaminated]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert planted and rows.keys() == docs.keys()
    for i in [*[r.doc_id for r in planted][:10], *sorted(docs)[:10]]:
        words, hit, names = brute(docs[i], items)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (rows[i].n_words, rows[i].n_hit, rows[i].n_items, rows[i].items_sha256, rows[i].contaminated) == (words, hit, len(names), sha, hit > 0)


def test_columns_named_as_those_used_inside(spark):
    names = ["_folded", "folded", "contamination", "_contamination", "words", "items", "spans"]
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x y"), (3, None)], "doc_id long, text string")
    clashing = docs.selectExpr("*", *[f"doc_id as `{n}`" for n in names])
    items = spark.createDataFrame([(7, "b c", 1)], "item_id long, text string, words long")
    got = decontaminate.clean_documents(clashing, items)
    assert got.columns == clashing.columns
    assert sorted((r.doc_id, *(r[n] for n in names)) for r in got.collect()) == [(i, *[i] * len(names)) for i in (2, 3)]
    marks = [r.mark for r in decontaminate.contamination(clashing, items, mark="mark").collect()]
    assert [(m.n_words, [tuple(s) for s in m.spans], m.items) for m in marks] == [(4, [(1, 3)], ["7"]), (2, [], []), (0, [], [])]
