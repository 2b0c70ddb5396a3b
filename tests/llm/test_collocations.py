"""Phrase collocations against plain counting."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, awkward, awkward_rows, empty, rows
from voxledger.llm import collocations


def brute(table, top, least, percent=50):
    """All phrases of one to three words, counted and scored with whole numbers."""
    counts, total = {}, Counter()
    for _, text, lang, *_ in table:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for k in (1, 2, 3):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(
                len(q) == 3 and b >= least and p in (q[:2], q[1:]) and 100 * b >= percent * a for q, b in f.items()
            ):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            best, k = min(cuts)
            found.append((-best, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def got(df, **kwargs):
    return sorted(tuple(r) for r in collocations.top_phrases(df, **kwargs).collect())


def test_awkward_rows(spark):
    want = brute(awkward_rows(), 2000, 2)
    assert want and got(awkward(spark), least=2) == want
    assert got(awkward(spark, clashing=True), least=2) == want
    assert rows(collocations.collocation_table(empty(spark))) == []


@pytest.mark.parametrize("top", [1, 7, 40])
def test_rounds_settle_ties_and_drops(spark, sf_dir, top, monkeypatch):
    """A small top makes cutoffs, rounds and ties take part; passes of few words make many partial counts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    table = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    rounds = []
    real = collocations._cutoffs
    monkeypatch.setattr(collocations, "_cutoffs", lambda *a: rounds.append(a) or real(*a))
    df = spark.createDataFrame([(i, t, lang, None, 0) for i, t, lang in table], DOCS)
    assert got(df, top=top, least=3, flush_words=997) == brute(table, top, 3)
    assert rounds


def test_dropped_pairs_make_a_language_need_more_rounds(spark):
    """Every pair is inside a phrase of three, so the first cutoff leaves too few survivors."""
    text = " ".join(f"a{i} b{i} c{i}." * (3 + i % 4) for i in range(30)) + " common a1. common b2. x y. x y. x z. x y. z y."
    table = [(1, text, "en"), (2, text, None)]
    df = spark.createDataFrame([(i, t, lang, None, 0) for i, t, lang in table], DOCS)
    assert got(df, top=5, least=2) == brute(table, 5, 2)
    assert got(df, top=31, least=2) == brute(table, 31, 2)


def test_slices_of_a_long_text(spark, monkeypatch):
    text = "one two  three.four\tFive six,\x0bseven \x1f eight " * 40
    whole = [w for part in collocations.text_tokens(text.encode()) for w in part]
    monkeypatch.setattr(collocations, "SLICE", 7)
    sliced = [w for part in collocations.text_tokens(text.encode()) for w in part]
    assert sliced == whole and whole[:6] == [b"one", b"two", b"three", b"\xff", b"four", b"five"]


def test_scores_are_exact(spark):
    values = [(10**12, 10**12 + 1, 10**12 + 7), (999_999_999_999, 10**12, 999_999_999_999), (10, 10, 10), (10, 11, 13), (3_037_000_500,) * 3]
    df = spark.createDataFrame(values, "a long, l long, r long")
    want = [(1_000_000 * a * a // (left * right), 1_000_000 * a // left) for a, left, right in values]
    made = df.select(collocations.score(F.col("a"), F.col("l"), F.col("r")), collocations.part_of(F.col("a"), F.col("l")))
    assert [tuple(r) for r in made.collect()] == want


def test_filters_hold_every_row(spark):
    pairs = [("en", f"w{i}", f"v{i * 7}") for i in range(5000)]
    bits = collocations.bit_filter(spark.createDataFrame(pairs, "lang string, w1 string, w2 string"), ["w1", "w2"], bits=20)
    import numpy as np

    h = lambda k, table: np.array([collocations.word_hash(p[0], p[k].encode()) for p in table], np.uint64)
    assert collocations._has(bits, collocations.slots(h(1, pairs), h(2, pairs), bits=20)).all()
    other = [("de", a, b) for _, a, b in pairs]
    assert collocations._has(bits, collocations.slots(h(1, other), h(2, other), bits=20)).mean() < 0.05
