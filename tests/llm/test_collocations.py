import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import collocations as c
from holdfast.llm.queries import op11_collocations


def pieces_of(text):
    folded = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def brute(rows, longest=3, least=10, share=50, first=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            total[lang] += len(words)
            for n in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in cand.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    held[p[i : i + n]] = max(held[p[i : i + n]], a)
        found = []
        for p, a in cand.items():
            score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            if p not in held or 100 * held[p] < share * a:
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def words_in_runs(text, size):
    before, c.CHUNK = c.CHUNK, size
    try:
        return [w for run in c.split_words(text.encode()) for w in run]
    finally:
        c.CHUNK = before


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB \t.,\n\r\x0b\x00é中\x1c\xa0"), max_size=60), st.integers(1, 20))
def test_words_and_pieces_whatever_the_chunk(text, size):
    said = b" ".join(words_in_runs(text, size)).split(b".")
    assert [p.split() for p in said if p.split()] == [[w.encode() for w in p] for p in pieces_of(text) if p]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.integers(1, 5))
def test_intervals_hold_every_pattern_in_both_directions(ids, depth):
    index = c.FmIndex(np.array(ids, np.int64), 5, depth)
    found, runs = c.single_words(index), "".join(map(str, ids)).split("0")
    for n in range(1, depth + 1):
        want = Counter(run[i : i + n] for run in runs for i in range(len(run) - n + 1))
        assert {"".join(map(str, w)): s for w, s in zip(found.words, found.sizes, strict=True)} == want
        for right in (True, False):
            text = index.ids[::-1] if right else index.ids
            rows = np.argsort([int("".join(map(str, [*text[i : i + depth], *[0] * depth][:depth]))) for i in range(len(text))], kind="stable")
            for word, start, size in zip(found.words, found.starts[right], found.sizes, strict=True):
                pattern = word[::-1] if right else word
                assert all(list(text[i : i + n]) == list(pattern) for i in rows[start : start + size])
        if n < depth:
            found = c.extended(index, found, right=bool(n % 3))


def test_a_sieve_lets_every_member_through():
    hashes = np.random.default_rng(1).integers(0, 2**64, 5_000, np.uint64)
    for size in (64, 1 << 16):
        sieve = np.zeros(size, np.uint64)
        cell, mask = c.sieve_cells(hashes[:2_500], size)
        np.bitwise_or.at(sieve, cell, mask)
        assert c.passes(sieve, hashes[:2_500]).all()
        assert size == 64 or c.passes(sieve, hashes[2_500:]).mean() < 0.01


def rows_of(seed=3, n=400):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "of", "New", "York", "city", *(f"w{i}" for i in range(40))]
    rows = []
    for i in range(n):
        words = [vocabulary[min(int(rng.exponential(6)), 44)] for _ in range(rng.integers(0, 30))]
        words[3:3] = ["New", "York", "City"] if i % 7 == 0 else ["in", "spite", "of"] if i % 5 == 0 else []
        rows.append((["en", "fr", None, "und"][i % 4], "  ".join(w + ("." if rng.random() < 0.1 else "") for w in words)))
    return [*rows, ("en", None), (None, ""), ("zz", "only once here"), ("en", " \t. ,;\x0b"), ("hot", "a b c " * 3000), ("en", "ÀÉ\x1cx ÀÉ\x1cx\xa0y " * 12)]


@pytest.mark.parametrize("shard_words,sieve_words", [(1 << 20, 1 << 16), (2, 64), (7, 128)])
def test_any_rows_in_shards_of_any_size(spark, shard_words, sieve_words):
    rows = rows_of()
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'x' as phrase", "1 as n", "2 as size", "3 as salt").repartition(3)
    assert got(c.collocations(df, shard_words=shard_words, sieve_words=sieve_words)) == brute(rows)
    if shard_words == 7:
        assert got(c.collocations(df, longest=4, least=5, share=80, first=20, shard_words=shard_words)) == brute(rows, 4, 5, 80, 20)


def test_awkward_rows_and_empty_tables(spark, awkward, nothing):
    df = awkward.selectExpr("*", "cast(null as string) as lang")
    assert got(c.collocations(df, least=2)) == brute([(None, r.text) for r in awkward.collect()], least=2)
    assert got(c.collocations(nothing.selectExpr("*", "1 as lang"))) == []


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    df = op11_collocations(spark, sf)
    assert [t for _, t in df.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert got(df) == brute(rows) != []
