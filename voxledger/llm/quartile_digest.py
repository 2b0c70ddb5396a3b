"""Document fingerprints: a digest of bucket quartiles, compared by a bounded difference score.

The byte triplets of every window of five bytes are hashed to buckets and counted. The digest holds a
step of the text's length and, for each bucket, the quarter of all bucket counts that its count lies
in (two bits). Two digests differ by the distance of these quarters and of the lengths; the score is
bounded, so a likeness from 0 to 1 comes of it.

``next_document_table`` compares each document with the next one in the order of ids and with an edit
of its own text, in one shuffle of the texts: see there.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import annotate, checkpoint, column, free_name

BUCKETS = 512
BLOCK = 1 << 20  # bytes of a text that are hashed at a time
#: Offsets of the triplets that begin at the first byte of a window of five bytes.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
#: Difference of two buckets by the distance of their quarters: opposite ends weigh double.
STEPS = np.array([0, 1, 2, 6], np.int64)
LENGTH_STEPS = 8  # per doubling of the length
LENGTH_MOST = 48  # the most that lengths add to a difference
MOST = int(STEPS[-1]) * BUCKETS + LENGTH_MOST
SPAN_BYTES = 32 << 20  # text of one range of documents
SAMPLE_PER_SPAN = 16


def bucket_counts(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Triplets of the whole text in each bucket; ``buckets`` is a power of two.

    A triplet is counted where it fits, so the last windows give those that do not pass the end.
    """
    counts = np.zeros(buckets, np.int64)
    drop = np.uint32(32 - (buckets.bit_length() - 1))
    for at in range(0, max(1, len(text)), BLOCK):
        part = np.frombuffer(text, np.uint8, min(len(text) - at, BLOCK + 4), at).astype(np.uint32)
        first = min(len(text) - at, BLOCK)  # windows that begin in this block
        for salt, (i, j, k) in enumerate(TRIPLETS):
            n = min(first, len(part) - k)
            if n <= 0:
                continue
            h = part[i : i + n] | part[j : j + n] << np.uint32(8)
            h |= part[k : k + n] << np.uint32(16)
            h |= np.uint32(salt << 24)
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA77)
            h >>= drop
            counts += np.bincount(h, minlength=buckets)
    return counts


def quarters(counts: np.ndarray) -> np.ndarray:
    """0 to 3 for each bucket: how many of the three quartiles of all counts lie below its count."""
    order = np.sort(counts)
    n = len(order)
    out = np.zeros(n, np.uint8)
    for cut in (order[n // 4 - 1], order[n // 2 - 1], order[3 * n // 4 - 1]):
        out += counts > cut
    return out


def digest(text: bytes | None) -> bytes:
    """Length step (one byte) and the quarters, four buckets a byte. Null is empty."""
    text = text or b""
    length = min(255, int(LENGTH_STEPS * np.log2(1 + len(text))))
    q = quarters(bucket_counts(text)).reshape(-1, 4)
    packed = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    return bytes([length]) + packed.astype(np.uint8).tobytes()


def difference(a: bytes, b: bytes) -> int:
    """0 (equal digests) to ``MOST``."""
    x, y = (np.frombuffer(d, np.uint8, offset=1) for d in (a, b))
    total = min(LENGTH_MOST, abs(a[0] - b[0]))
    for shift in (0, 2, 4, 6):
        step = (x >> shift & 3).astype(np.int8) - (y >> shift & 3).astype(np.int8)
        total += int(STEPS[np.abs(step)].sum())
    return total


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / MOST


def with_digest(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, result: str = "digest") -> DataFrame:
    """Rows with a struct ``result`` that holds the ``fingerprint`` of each whole text in hex; a map.

    Null and empty texts share the fingerprint of the empty text; texts of any length are read in
    blocks. Equal texts have equal fingerprints, so repeated rows do. A clashing column name is kept
    and ``result`` renamed; an empty table gives an empty result.
    """
    fields = T.StructType([T.StructField("fingerprint", T.StringType())])

    def make():
        return lambda texts: {"fingerprint": [digest(t).hex() for t in texts]}

    return annotate(docs, text, make, fields, free_name(docs, result), keep)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _cuts(docs: DataFrame, span_bytes: int) -> tuple[list[tuple], tuple | None]:
    """Keys (``no_id``, ``id``, ``mark``) of rows that begin a span, ascending, and the smallest key.

    The cuts are taken from a sample of a few rows per span, so they are rows of the table; what is
    collected is a few dozen bytes per ``span_bytes`` of text.
    """
    keys = checkpoint(docs.select("no_id", "id", "mark", F.octet_length("text").alias("size")))
    low, size, rows = keys.agg(F.min(F.struct("no_id", "id", "mark")), F.sum("size"), F.count("*")).first()
    if not rows:
        return [], None
    spans = min(rows, max(1, -(-(size or 0) // span_bytes)))
    if spans == 1:
        return [], tuple(low)
    wanted = spans * SAMPLE_PER_SPAN
    one_in = max(1, rows // (2 * wanted))
    sample = (
        keys.where(F.pmod(F.xxhash64("id", "mark"), F.lit(one_in)) == 0)
        .groupBy("no_id", "id", "mark")
        .agg(F.count("*").alias("n"))
        .orderBy(F.xxhash64("id", "mark", F.lit(1)), "no_id", "id", "mark")
        .limit(wanted)
        .collect()
    )
    found = sorted((tuple(r)[:3] for r in sample), key=_order)
    picked = {i * len(found) // spans for i in range(1, spans)} if found else ()
    return [found[i] for i in sorted(picked) if _order(found[i]) > _order(tuple(low))], tuple(low)


def _order(key: tuple) -> tuple:
    """A key as Python compares it: null ids (``no_id``) come last, by their mark alone."""
    no_id, id_, mark = key
    return (no_id, () if id_ is None else (id_,), bytes(mark))


def next_document_table(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", span_bytes: int = SPAN_BYTES
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_chars``, the SHA-256 of the edited text, the fingerprints of
    the text and of the edited text, and ``near_edited`` and ``near_next``: their likeness, and that of the
    text and the next document's.

    The edited text is ``edited(text, next text)``; next is by ascending id, after the last comes the
    first. Null ids come last; rows with one id are ordered by the SHA-256 of their texts. Of rows
    that repeat id and text each is followed by the next copy, the last copy by what follows. Null texts are
    empty, a single row is its own successor, an empty table gives an empty result, and other
    columns (clashing ones too) are not read.

    The order is cut at rows of a sample into spans of about ``span_bytes`` of text. A row goes to its
    span, and the row that begins a span also to the end of the span before, so every row meets its
    successor in a sorted stream and only texts move, once. Copies within a batch travel as one row
    with a count, so a hot id or a hot row is no hot span.
    """
    source = docs.select(
        column(id_col).isNull().cast("int").alias("no_id"),
        column(id_col).alias("id"),
        F.unhex(F.sha2(F.coalesce(column(text), F.lit("")).cast("binary"), 256)).alias("mark"),
        F.coalesce(column(text), F.lit("")).cast("string").alias("text"),
    )
    cuts, low = _cuts(source, span_bytes)
    bounds = [_order(c) for c in cuts]
    heads = {b: i for i, b in enumerate(bounds)}  # begins span i + 1, ends span i
    if low is not None:
        heads[_order(low)] = len(bounds)
    fields = [
        T.StructField("span", T.IntegerType()),
        T.StructField("tail", T.IntegerType()),
        *source.schema.fields,
        T.StructField("times", T.LongType()),
    ]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            first: dict[tuple, int] = {}
            times: list[int] = []
            rows: list[int] = []
            for at, key in enumerate(keys):
                place = first.setdefault(key, len(rows))
                if place == len(rows):
                    rows.append(at)
                    times.append(0)
                times[place] += 1
            order = [_order(keys[at]) for at in rows]
            span = [bisect_right(bounds, o) for o in order]
            ends = [(i, heads[o]) for i, o in enumerate(order) if o in heads]
            take = pa.array(rows + [rows[i] for i, _ in ends], pa.int64())
            moved = batch.take(take)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(span + [s for _, s in ends], pa.int32()),
                    pa.array([0] * len(rows) + [1] * len(ends), pa.int32()),
                    *moved.columns,
                    pa.array(times + [1] * len(ends), pa.int64()),
                ],
                names=[f.name for f in fields],
            )

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [source.schema["id"].dataType, T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    out = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        held = None  # the row whose successor is still to come: (span, key, id, text, digest, times)
        for batch in batches:
            id_type = batch.schema.field("id").type
            made: list[list] = [[] for _ in names]
            span, tail, no_id, ids, mark, texts, times = (batch.column(i) for i in range(7))
            for i in range(batch.num_rows):
                at, key = span[i].as_py(), (no_id[i].as_py(), ids[i].as_py(), mark[i].as_py())
                ends = tail[i].as_py()
                if held is not None and held[0] == at and held[1] == key and not ends:
                    held[5] += times[i].as_py()
                    continue
                if ends and (held is None or held[0] != at):
                    continue  # a further copy of the row that ends a span
                body = texts[i].as_py()
                row = [at, key, key[1], body, digest(body.encode()), times[i].as_py()]
                if held is not None:
                    _pairs(held, row, made)
                held = None if ends else row
            if made[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[0], id_type), *[pa.array(m, k) for m, k in zip(made[1:], _ARROW)]], names=names
                )

    partitions = max(1, len(bounds) + 1)
    dealt = source.mapInArrow(deal, T.StructType(fields)).repartition(partitions, "span")
    streamed = dealt.sortWithinPartitions("span", "tail", "no_id", "id", "mark").mapInArrow(compare, out)
    return streamed.withColumnRenamed("id", id_col)


_ARROW = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _pairs(row: list, following: list, made: list[list]) -> None:
    """The results of ``row``: copies but the last are followed by themselves, the last by ``following``."""
    _, _, id_, body, own, times = row
    for other, n in ((row, times - 1), (following, 1)):
        if n:
            changed = edited(body, other[3]).encode()
            print_ = own if other is row and changed == body.encode() else digest(changed)
            values = [
                id_, len(body), hashlib.sha256(changed).hexdigest(), own.hex(), print_.hex(),
                likeness(own, print_), likeness(own, other[4]),
            ]
            for field, value in zip(made, values):
                field.extend([value] * n)


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return next_document_table(docs)
