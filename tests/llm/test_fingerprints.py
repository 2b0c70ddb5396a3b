"""Quartile digests and the table of next documents against plain computations."""

import hashlib

import numpy as np
import pytest

from tests.llm.cases import DOCS, awkward, awkward_rows, empty
from voxledger.llm import quartile_digest as q


def plain_digest(text: bytes) -> bytes:
    """Every triplet of every window of five bytes, one by one."""
    counts = [0] * q.BUCKETS
    for at in range(len(text)):
        for salt, places in enumerate(q.TRIPLETS):
            if at + places[2] < len(text):
                a, b, c = (text[at + p] for p in places)
                h = (a | b << 8 | c << 16 | salt << 24) * 0x9E3779B1 % 2**32
                h = (h ^ h >> 15) * 0x85EBCA77 % 2**32
                counts[h >> 23] += 1
    order = sorted(counts)
    cuts = [order[q.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    code = [sum(c > cut for cut in cuts) for c in counts]
    out = [min(255, int(q.LENGTH_STEPS * np.log2(1 + len(text))))]
    out += [code[i] | code[i + 1] << 2 | code[i + 2] << 4 | code[i + 3] << 6 for i in range(0, q.BUCKETS, 4)]
    return bytes(out)


def plain_likeness(a: bytes, b: bytes) -> float:
    codes = lambda d: [d[1 + i // 4] >> 2 * (i % 4) & 3 for i in range(q.BUCKETS)]
    steps = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(codes(a), codes(b)))
    return 1 - (steps + min(q.LENGTH_MOST, abs(a[0] - b[0]))) / (6 * q.BUCKETS + q.LENGTH_MOST)


def brute(table):
    order = sorted(table, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()))
    out = []
    for i, (id_, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        prints = [plain_digest(t.encode()) for t in (text, changed, after)]
        out.append(
            (id_, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0].hex(), prints[1].hex(),
             plain_likeness(prints[0], prints[1]), plain_likeness(prints[0], prints[2]))
        )
    return sorted(out, key=repr)


def got(df, **kwargs):
    return sorted((tuple(r) for r in q.next_document_table(df, **kwargs).collect()), key=repr)


SHORT = [r if len(r[1] or "") < 5000 else (r[0], r[1][:4999], *r[2:]) for r in awkward_rows()]


@pytest.mark.parametrize("span_bytes", [1, 400, 1 << 20])
def test_table(spark, span_bytes):
    """Spans of one row, of a few, and one span give one result."""
    df = spark.createDataFrame(SHORT, DOCS).repartition(3)
    want = brute(SHORT)
    names = q.fingerprint_table(df).columns
    assert names == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert got(df, span_bytes=span_bytes) == want


def test_awkward_tables(spark):
    assert len(got(awkward(spark, clashing=True), span_bytes=1000)) == len(awkward_rows())
    assert got(empty(spark)) == []
    one = [(5, "a single row of text", None, None, None)]
    assert got(spark.createDataFrame(one, DOCS)) == brute(one)


def test_hot_rows(spark):
    """Two thirds of the rows are copies of one row, or share a null id."""
    table = [(3, "copy of a row", "en", "a", 1)] * 300 + [(None, f"no id {i % 50}", "en", "a", 1) for i in range(300)]
    table += [(i, f"text number {i}", "en", "a", 1) for i in range(100)]
    df = spark.createDataFrame(table, DOCS).repartition(5)
    assert got(df, span_bytes=300) == brute(table)


def test_blocks_of_a_long_text(monkeypatch):
    text = bytes(np.random.default_rng(1).integers(0, 256, 5000, np.uint8))
    whole = q.digest(text)
    assert whole == plain_digest(text)
    for block in (1, 3, 64, 4999, 5000):
        monkeypatch.setattr(q, "BLOCK", block)
        part = text if block > 10 else text[:300]
        assert q.digest(part) == plain_digest(part)


def test_difference_is_bounded():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (bytes(rng.integers(0, 256, 1 + q.BUCKETS // 4, np.uint8)) for _ in range(2))
        assert 0 <= q.likeness(a, b) <= 1 and q.likeness(a, a) == 1 and q.difference(a, b) == q.difference(b, a)
    far = bytes([0]) + bytes(q.BUCKETS // 4), bytes([255] * (1 + q.BUCKETS // 4))
    assert q.likeness(*far) == 0


def test_edits_are_nearer_than_other_documents(spark, sf_dir):
    """Every edited text is nearer than the next document, but for copies and very short texts."""
    found = q.fingerprint_table(spark.read.parquet(f"{sf_dir}/documents.parquet")).toPandas()
    long = found[(found.n_chars >= 200) & (found.near_next < 0.99)]
    assert (long.near_edited > long.near_next).mean() >= 0.99
