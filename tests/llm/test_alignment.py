import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from holdfast.llm import alignment
from holdfast.llm.queries import op12_token_alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
OWN = alignment.worker_pair("byte_bpe_50k.json", "piece_bpe_32k.model", 20_000)
ALPHABET = alignment.byte_alphabet()
TEXT = st.text(st.sampled_from("ab'sé中🙂 \t\n  \xa0\x85\x1c　\x00<>|.1२ß́▁ﬁ"), max_size=40)
TEXT |= st.lists(st.sampled_from(["<|endoftext|>", "<s>", "</s>", "<0x41>", "the", " ", "  ", "\n", "don't", "naïve", "🙂🙂", "한국어", "x" * 70, "٣", "a‍b"]), max_size=12).map("".join)


def tokens(text):
    """The ids and byte lengths of both tokenizers over a whole text, or None."""
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    a_bytes = [bytes(ALPHABET[c] for c in A.id_to_token(i)) for i in a]
    names = [B.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(n[3:5], 16)]) if B.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names, strict=True)]
    whole = (" " + text).encode()
    if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None
    return a, [len(x) for x in a_bytes], b, [len(x) for x in b_bytes]


def brute(text):
    """groups, links (a id, b id), by walking through the bytes of both."""
    found = tokens(text)
    if found is None:
        return "", [], 0, 0
    a, a_len, b, b_len = found
    of_a, of_b = ([i for i, n in enumerate(ns) for _ in range(n)] for ns in (a_len, b_len))
    links = sorted(set(zip(of_a, of_b, strict=True)))
    groups, i, j, at_a, at_b = [], 0, 0, 0, 0
    for n, m in links:
        at_a, at_b = sum(a_len[: n + 1]), sum(b_len[: m + 1])
        if at_a == at_b:
            groups.append(",".join(map(str, a[i : n + 1])) + "|" + ",".join(map(str, b[j : m + 1])))
            i, j = n + 1, m + 1
    return ";".join(groups), [(a[n], b[m]) for n, m in links], len(a), len(b)


def brute_rows(rows):
    found = [brute(t or "") for _, t in rows]
    counts = Counter(pair for _, links, _, _ in found for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted(
        ((i, n_a, n_b, len(g.split(";")) if g else 0, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
          hashlib.sha256(g.encode()).hexdigest() if g else "")
         for (i, _), (g, links, n_a, n_b) in zip(rows, found, strict=True)), key=str)


def got(df):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    rows = [tuple(r) for r in df.select("doc_id", *[f"alignment.{c}" for c in columns]).collect()]
    return sorted(((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in rows), key=str)


@settings(max_examples=500, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_words_apart_give_the_libraries_own_alignment(texts):
    assert OWN.words_apart
    for text, found in zip(texts, OWN.align_all(texts), strict=True):
        groups, links, n_a, n_b = brute(text)
        if found is None:
            assert groups == ""
            continue
        pairs = np.frombuffer(found[4], np.int64)
        assert found[:3] == (groups, n_a, n_b)
        assert sorted(zip((pairs // B.get_piece_size()).tolist(), (pairs % B.get_piece_size()).tolist(), strict=True)) == sorted(links)
        assert len(links) == n_a + n_b - found[3]


def test_coarse_cuts_and_their_refinement():
    def ends(spans, lengths):
        starts, stops = (np.array(x) for x in zip(*spans, strict=True))
        return alignment.refined(starts, stops, np.array(lengths)).tolist()

    assert ends([(0, 2), (2, 5)], [2, 3]) == [2, 5]
    #: three tokens of one character, by the same span or by empty ones
    assert ends([(0, 1), (1, 4), (1, 4), (1, 4)], [1] * 4) == [1, 2, 3, 4]
    assert ends([(0, 1), (1, 1), (1, 1), (1, 4)], [1] * 4) == [1, 2, 3, 4]
    assert ends([(0, 1), (1, 3)], [2, 2]) == [2, 4]


def rows_of(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.mark.parametrize("most", [alignment.BROADCAST_PAIRS, 10])
def test_scores_by_broadcast_and_by_join(spark, awkward, most):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    rows += [(100 + i, t) for i, t in enumerate(["The cat. ", "the cat", "the▁cat", "<|endoftext|> <s> x", " ", "the  cat\n sat", "é" * 50] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as pair", "1 as n", "true as best", "2 as salt", "3 as link", "4 as pairs", "5 as row").repartition(3)
    scored = alignment.score_alignments(alignment.align(df), most=most, held=50)
    assert scored.columns == [*df.columns, "alignment"]
    assert got(scored) == brute_rows(rows)


def test_empty_tables_and_clashes(spark, nothing):
    assert got(alignment.score_alignments(alignment.align(nothing))) == []
    names = ["pairs", "row", "count_sum", "given_0", "n_a", "a.b"]
    clashing = spark.createDataFrame([(1, "a", *names)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    (row,) = alignment.score_alignments(alignment.align(clashing)).collect()
    assert [row[n] for n in names] == names and row.alignment.count_sum == row.alignment.n_best == 1
    with pytest.raises(ValueError, match="alignment"):
        alignment.align(nothing.selectExpr("*", "1 as alignment"))


def test_query_against_brute_force(spark, sf):
    rows = rows_of(spark, sf)
    df = op12_token_alignment(spark, sf)
    assert [t for _, t in df.dtypes] == [*["bigint"] * 7, "string"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == brute_rows(rows)
