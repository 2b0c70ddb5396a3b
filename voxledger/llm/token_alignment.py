"""Cross-tokenizer alignment: the tokens of two tokenizers over one text, grouped by interval coalescing.

Tokens of A and B are byte intervals. Sorted by start, with the running maximum of their ends, they fall
into groups: a group begins where a start reaches the maximum before it. Within a group, the pairs
whose intervals overlap are the links. How many documents hold an id pair linked is counted over all
documents: documents are packed into shards of bounded size, each shard names every id pair once, the
pairs are counted as rows, and the counts come back to the shard as rows before those of its documents.
A row is a pair of a shard or one document, never a whole shard.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import checkpoint, column
from voxledger.session import shared_dir

SHARD_BYTES = 4 << 20  # text of a shard; one longer text is a shard of its own
SLICE_CHARS = 256 << 10  # text that is encoded at once
BATCH_BYTES = 1 << 20  # what leaves Python at once, about
GROUP_BYTES = 16 << 20  # row group of a stored shard, about
SPACE = "▁"  # stands for U+0020 in the pieces of B
#: Fixed value: the published pattern that parts the words of the byte-level vocabulary.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lead bytes of characters below U+0240, and all bytes that follow a lead byte.
LATIN = bytes(range(0xC9))


@dataclass(frozen=True)
class Tokenizer:
    """A way to ids (of a list of texts) and the bytes of every id."""

    encode: Callable[[list[str]], list[np.ndarray]]
    entries: list[bytes | None]


def byte_level_bytes() -> dict[str, int]:
    """The bytes that characters of a byte-level vocabulary stand for: printable ones for themselves,
    the others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(2)  # a worker keeps what it has read
def byte_level_tokenizer(path: str) -> Tokenizer:
    """A: a byte-level ``.json`` file; a space is put before a text, special strings are plain text.

    Texts whose characters all lie below U+0240 go through ``tiktoken`` over the ranks of the same file,
    which gives the same ids there in a third of the time; others through ``tokenizers``. Both
    split words by one pattern, but their tables of letters differ among rare characters.
    """
    import tiktoken
    from tokenizers import Tokenizer as Library

    library = Library.from_file(path)
    library.encode_special_tokens = True
    added = {t.content for t in library.get_added_tokens_decoder().values()}
    back = byte_level_bytes()
    entries: list[bytes | None] = [None] * library.get_vocab_size(with_added_tokens=True)
    ranks = {}
    for token, i in library.get_vocab(with_added_tokens=True).items():
        if token in added:
            entries[i] = token.encode()
        else:
            entries[i] = bytes(back[c] for c in token)
            ranks[entries[i]] = i
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    fast = None
    if _ranks_follow_merges(merges, ranks, back):
        fast = tiktoken.Encoding("byte-level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            text = " " + text
            if fast is not None and not text.encode().translate(None, LATIN):
                ids = fast.encode_ordinary(text)
            else:
                ids = library.encode(text, add_special_tokens=False).ids
            out.append(np.array(ids, np.int64))
        return out

    return Tokenizer(encode, entries)


def _ranks_follow_merges(merges: list, ranks: dict[bytes, int], back: dict[str, int]) -> bool:
    """True if a pair that merges earlier has the lower id: ids are then ranks."""
    last = -1
    for merge in merges:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        at = ranks.get(bytes(back[c] for c in left + right))
        if at is None or at <= last:
            return False
        last = at
    return True


@lru_cache(2)
def piece_tokenizer(path: str) -> Tokenizer:
    """B: a sentencepiece ``.model`` file, which puts a space before a text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries: list[bytes | None] = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in model.encode(texts, num_threads=1)]

    return Tokenizer(encode, entries)


@dataclass(frozen=True)
class Alignment:
    """Groups and links of two lists of tokens over the same bytes."""

    group_a: np.ndarray  # group of each A token
    group_b: np.ndarray
    n_groups: int
    link_a: np.ndarray  # places of the tokens of each link
    link_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Coalesce the intervals of A and B, given by their ends; both cover the same bytes, without gaps."""
    starts_a, starts_b = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (ends_a, ends_b))
    n = len(ends_a)
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    which = np.repeat([0, 1], [n, len(ends_b)])
    order = np.lexsort((which, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    # Tokens of B that overlap a token of A are neighbours: from the first that ends after its start.
    low = np.searchsorted(ends_b, starts_a, "right")
    count = np.searchsorted(starts_b, ends_a, "left") - low
    link_a = np.repeat(np.arange(n), count)
    link_b = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return Alignment(group[:n], group[n:], int(fresh.sum()), link_a, link_b)


_POWERS = 10 ** np.arange(9, -1, -1)


def group_text(a: np.ndarray, b: np.ndarray, found: Alignment) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group in order, decimal."""
    if not found.n_groups:
        return b""
    in_a, in_b = (np.bincount(g, minlength=found.n_groups) for g in (found.group_a, found.group_b))
    before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    place_a = np.arange(len(a)) + before_b[found.group_a]
    place_b = np.arange(len(b)) + (before_a + in_a)[found.group_b]
    ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[np.cumsum(in_a) + before_b - 1] = ord("|")
    mark[np.cumsum(in_a) + np.cumsum(in_b) - 1] = ord(";")
    width = len(str(int(ids.max())))
    powers = _POWERS[-width:]
    text = np.empty((len(ids), width + 1), np.uint8)
    text[:, :width] = ids[:, None] // powers % 10 + ord("0")
    text[:, width] = mark
    keep = np.ones(text.shape, bool)
    keep[:, : width - 1] = ids[:, None] >= powers[:-1]
    return text[keep][:-1].tobytes()


class Packer:
    """Documents of a shard: their numbers, and their links as places in the shard's list of id pairs."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b = a, b
        self.length_a, self.length_b = (np.array([len(e or b"") for e in t.entries], np.int64) for t in (a, b))
        self.clear()

    def clear(self) -> None:
        self.rows: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, texts: list[str | None]) -> None:
        texts = [t or "" for t in texts]
        for id_, text, a, b in zip(ids, texts, self.a.encode(texts), self.b.encode(texts)):
            self.size += len(text)
            row = {"id": id_, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
            codes, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
            whole = b" " + text.encode()
            if text and all(
                b"".join(map(t.entries.__getitem__, i.tolist())) == whole for t, i in ((self.a, a), (self.b, b))
            ):
                found = align(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]))
                codes, times = np.unique(a[found.link_a] << 32 | b[found.link_b], return_counts=True)
                row |= {
                    "n_a": len(a), "n_b": len(b), "n_groups": found.n_groups, "n_links": len(found.link_a),
                    "groups_sha256": hashlib.sha256(group_text(a, b, found)).hexdigest(),
                }
            self.rows.append(row | {"times": times})
            self.pairs.append(codes)

    def shard(self) -> tuple[np.ndarray, np.ndarray, list[dict]]:
        """The shard's distinct pairs, the number of documents that hold each, and its documents."""
        held = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        pairs, place, n_docs = np.unique(held, return_inverse=True, return_counts=True)
        ends = np.cumsum([len(p) for p in self.pairs])
        docs = []
        for row, places in zip(self.rows, np.split(place.reshape(-1), ends[:-1])):
            docs.append(row | {"places": places.astype(INT).tobytes(), "times": row["times"].astype(INT).tobytes()})
        self.clear()
        return pairs, n_docs, docs


INT = np.dtype("<i4")  # places and times are stored as bytes
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _packed_type(id_type: T.DataType) -> T.StructType:
    """A pair of a shard has a place there; a document has none, but places (in the shard's pairs) and times of its links."""
    return T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("place", T.IntegerType()),
            T.StructField("pair", T.LongType()),
            T.StructField("n_docs", T.LongType()),
            T.StructField("id", id_type),
            *[T.StructField(n, T.LongType()) for n in NUMBERS],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("places", T.BinaryType()),
            T.StructField("times", T.BinaryType()),
        ]
    )


def pack(docs: DataFrame, make: Callable[[], tuple[Tokenizer, Tokenizer]], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows of shards of ``docs`` (``id``, ``text``) of about ``shard_bytes`` characters; a map.

    A task packs its rows as they come and numbers its shards, so the table must be stored before it is
    read twice.
    """
    fields = _packed_type(docs.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(*make())
        schema = None
        shard = TaskContext.get().partitionId() << 32

        def made(n: int, columns: dict) -> pa.RecordBatch:
            columns["shard"] = np.full(n, shard)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
            )

        def flush() -> Iterator[pa.RecordBatch]:
            pairs, n_docs, docs_ = packer.shard()
            step = BATCH_BYTES // 64  # bytes of a pair, with the columns that it lacks
            for at in range(0, len(pairs), step):
                some = slice(at, at + step)
                columns = {"place": np.arange(len(pairs))[some].astype(np.int32), "pair": pairs[some], "n_docs": n_docs[some]}
                yield made(len(pairs[some]), columns)
            at = size = 0
            for stop, doc in enumerate(docs_, 1):
                size += len(doc["places"]) + len(doc["times"])
                if size >= BATCH_BYTES or stop == len(docs_):
                    yield made(stop - at, {name: [d[name] for d in docs_[at:stop]] for name in docs_[at]})
                    at, size = stop, 0

        for batch in batches:
            if schema is None:
                schema = _arrow(fields, batch.schema.field(0).type)
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                stop, size, room = at, 0, min(shard_bytes - packer.size, SLICE_CHARS)
                while stop < len(ids) and (size < room or stop == at):
                    size += len(texts[stop].as_py() or "")
                    stop += 1
                packer.add(ids[at:stop], texts[at:stop].to_pylist())
                at = stop
                if packer.size >= shard_bytes:
                    yield from flush()
                    shard += 1
        if packer.rows:
            yield from flush()

    return docs.mapInArrow(run, fields)


def _arrow(fields: T.StructType, id_type: pa.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([pa.field(f.name, id_type if f.name == "id" else to_arrow_type(f.dataType)) for f in fields])


def pair_counts(listed: DataFrame) -> DataFrame:
    """``pair`` (A id times 2^32 plus B id), ``n`` (documents that hold it) and ``best`` (the highest of its A id)."""
    counts = checkpoint(listed.groupBy("pair").agg(F.sum("n_docs").alias("n")))
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.join(best, F.shiftright("pair", 32) == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def align_documents(
    docs: DataFrame,
    make: Callable[[], tuple[Tokenizer, Tokenizer]],
    *,
    id_col: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    and ``groups_sha256``.

    ``make`` returns tokenizers A and B in a task. A text that is null or empty, or that the tokens of A
    or B do not spell (after one space), has zeros and an empty digest. Repeated rows and equal texts
    are documents of their own in the counts. Other columns, clashing ones too, are not read; an empty
    table gives an empty result. A very long text is a shard of its own.

    Texts are read once and never moved. Shards are stored; what moves is each shard's distinct pairs
    with their counts, and its documents' links to meet them: a pair in every document is one row per
    shard, added up before it moves. Rows are sorted by shard, so a task holds the counts of one.
    """
    source = docs.select(column(id_col).alias("id"), column(text).cast("string").alias("text"))
    path = shared_dir(docs.sparkSession, "token-shards")
    pack(source, make, shard_bytes).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    shards = docs.sparkSession.read.parquet(path)
    listed = shards.where("place IS NOT NULL")
    counts = checkpoint(pair_counts(listed))
    found = listed.select("shard", "place", "pair").join(counts, "pair").drop("pair")
    packed = shards.where("place IS NULL").drop("place", "pair", "n_docs")
    met = found.unionByName(packed, allowMissingColumns=True)
    ordered = met.repartition("shard").sortWithinPartitions("shard", F.col("place").asc_nulls_last())
    id_type = source.schema["id"].dataType
    names = ["id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]
    kinds = [id_type, *[T.LongType()] * 6, T.StringType()]
    out = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, counts_, best_ = None, [], []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            is_doc = batch.column("place").is_null().to_numpy(zero_copy_only=False)
            ends = np.flatnonzero((shard[1:] != shard[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
            for low, high in zip([0, *ends.tolist()], [*ends.tolist(), len(shard)]):
                rows = batch.slice(low, high - low)
                if shard[low] != last:
                    last, counts_, best_ = shard[low], [], []
                if not is_doc[low]:
                    counts_.append(rows.column("n").to_numpy())
                    best_.append(rows.column("best").to_numpy(zero_copy_only=False))
                    continue
                if len(counts_) > 1:
                    counts_, best_ = [np.concatenate(counts_)], [np.concatenate(best_)]
                place, time = (np.frombuffer(b"".join(rows.column(c).to_pylist()), INT) for c in ("places", "times"))
                links = pc.binary_length(rows.column("places")).to_numpy() // INT.itemsize
                ends_ = np.cumsum(np.concatenate([[0], links]))
                sums = []
                for value in (best_, counts_):
                    total = np.concatenate([[0], np.cumsum(value[0][place] * time.astype(np.int64))]) if len(place) else np.zeros(1, np.int64)
                    sums.append(pa.array(total[ends_[1:]] - total[ends_[:-1]], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(n) for n in ["id", *NUMBERS]], *sums, rows.column("groups_sha256")], names=names
                )

    return ordered.mapInArrow(run, out).withColumnRenamed("id", id_col)


def alignment_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The result of ``align_documents`` for a byte-level ``.json`` file A and a ``.model`` file B."""
    return align_documents(docs, lambda: (byte_level_tokenizer(path_a), piece_tokenizer(path_b)))
