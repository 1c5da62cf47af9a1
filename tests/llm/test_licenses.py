import random

from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import licenses
from holdfast.llm.common import folded_words
from holdfast.llm.queries import op6_license_scan

NOTICES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
    "All rights reserved.": "all-rights-reserved",
}


@settings(max_examples=200, deadline=None)
@given(st.permutations(range(9)))
def test_increasing_is_a_longest_increasing_subsequence(values):
    chain = [values[i] for i in licenses.increasing(values)]
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
    assert chain == sorted(chain) and len(chain) == max(best)


WORDS = st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e"]), max_size=20)


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_alignment_matches_equal_words_in_order(text, template):
    pairs = licenses.align(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    if text == template:
        assert len(pairs) == len(text)


def scan(text):
    return licenses.Scanner(licenses.TEMPLATES).scan(folded_words(text.encode()))


def test_every_template_is_found_whole_anywhere():
    rng = random.Random(0)
    noise = lambda n: " ".join(rng.choice(["the", "of", "under", "license", "foo", "bar", "all"]) for _ in range(n))
    for name, body in licenses.TEMPLATES.items():
        found = scan(f"{noise(300)} zzz\n{body}\nzzz {noise(300)}")
        assert [m.license for m in found if m.coverage == 1.0 and m.words > 2] == ([name] if len(folded_words(body.encode())) > 2 else [])


def test_edited_texts_and_other_versions():
    words = licenses.TEMPLATES["mit-text"].split()
    edited = [w for i, w in enumerate(words) if i % 12 != 5]
    (found,) = scan("start " + " ".join(edited) + " end")
    assert found.license == "mit-text" and 0.85 < found.coverage < 1 and found.start == 1
    (found,) = scan("This work is licensed under the GNU General Public License, version 2.")
    assert found.license == "gpl-2.0"
    assert scan(" ".join(words[: len(words) // 2])) == []
    assert scan("") == []
    (a, b) = scan("All rights reserved. All rights reserved.")
    assert a.license == b.license == "all-rights-reserved" and a.end <= b.start


def test_relatives_are_told_apart():
    named = {
        "Released under the BSD License.": ["bsd"],
        "This work is licensed under the GNU Lesser General Public License, version 3.": ["lgpl-3.0"],
        "This work is licensed under the GNU Affero General Public License, version 3.": ["agpl-3.0"],
        "Licensed under CC BY-NC-SA 4.0.": ["cc-by-nc-sa-4.0"],
        "Licensed under CC BY-ND 4.0.": ["cc-by-nd-4.0"],
        "Licensed under CC BY-NC-ND 4.0.": ["cc-by-nc-nd-4.0"],
        "all human rights reserved": [],
        "Released under the Foo License.": [],
        licenses.TEMPLATES["gpl-header"]: ["gpl-header"],
        licenses.TEMPLATES["gpl-header"].replace("General", "Lesser General"): [],
        licenses.TEMPLATES["mpl-2.0-header"]: ["mpl-2.0-header"],
    }
    assert {text: [m.license for m in scan(f"some words {text} more words")] for text in named} == named


def test_a_dense_enough_notice_is_found_wherever_the_other_words_stand():
    words = licenses.TEMPLATES["mit-text"].split()
    for at in (1, 10, len(words) // 2, len(words) - 10, len(words) - 1):
        text = " ".join([*words[:at], *["other"] * 25, *words[at:]])
        assert [m.license for m in scan(f"start {text} end")] == ["mit-text"]


def test_a_column_of_the_inner_name_passes_through(spark):
    df = spark.createDataFrame([("All rights reserved.", "x", "y")], "text string, _text string, __text string")
    row = licenses.scan_licenses(df).first()
    assert (row["_text"], row["__text"], len(row["licenses"])) == ("x", "y", 1)


def test_query_finds_the_planted_notices_and_no_others(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_license_scan(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = sorted(NOTICES[line] for line in docs[r.doc_id].split("\n") if line in NOTICES)
        got = sorted(p.split(":")[0] for p in r.places.split(",") if p)
        assert got == want and r.n_licenses == len(want) and (r.license is None) == (not want)


def test_awkward_rows(awkward, nothing):
    found = licenses.scan_licenses(awkward)
    assert found.columns == [*awkward.columns, "licenses"]
    assert all(r.licenses == [] for r in found.collect())
    assert licenses.scan_licenses(nothing).count() == 0
