"""Benchmark decontamination with suffix arrays over the training texts.

Every batch of training texts is a shard with a suffix array over its words; every suffix of every
benchmark item is binary-searched in it. The neighbours of the place found give the longest verbatim
match; where it reaches the length of a window, a second pair of searches gives all its places.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import annotate, checkpoint, column, free_name, words

WINDOW = 13
SLICE_BYTES = 16 << 20  # benchmark text that a task holds at a time
LEAD = 3  # words that are compared before a suffix enters the array

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("longest", T.LongType()),
        T.StructField("longest_start", T.LongType()),
        T.StructField("longest_item", T.StringType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


class Items:
    """A bounded slice of benchmark items as one array of word numbers, with its windows.

    Equal windows are one window with a list of items. ``tokens`` has a 0 after each item; 0 is also
    the number of every word that no item has. Everything but the table of words is in arrays, and
    runs of words are compared by ranks, so any number of distinct words keeps its place.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        names, parts = [], []
        for name, text in sorted(items, key=lambda x: (x[0], x[1] or b"")):
            tokens = words(text)
            if tokens:
                for w in tokens:
                    self.number.setdefault(w, len(self.number) + 1)
                parts.append(np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens)))
                names.append(name)
        sizes = np.array([len(p) for p in parts], np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        self.names = names
        gap = np.zeros(1, np.int64)
        self.tokens = np.concatenate([*(x for p in parts for x in (p, gap)), np.zeros(LEAD + 1, np.int64)])
        self.start = ranges(first, sizes)
        self.left = np.repeat(first + sizes, sizes) - self.start
        width = np.minimum(window, sizes)
        self.lead = int(min([LEAD, *width.tolist()]))
        self.longest = int(sizes.max(initial=0))
        self.leads = Leads(self.tokens, self.start, self.lead)
        # Windows of one width are equal if their ranks are; a window is named after its first item.
        at = ranges(first, sizes - width + 1)
        item, size = (np.repeat(x, sizes - width + 1) for x in (np.arange(len(names)), width))
        rank = np.zeros(len(at), np.int64)
        for k in np.unique(width):
            mine = size == k
            rank[mine] = run_ranks(self.tokens, int(k))[at[mine]]
        by = np.lexsort((at, rank, size))
        new = np.ones(len(by), bool)
        new[1:] = (np.diff(rank[by]) != 0) | (np.diff(size[by]) != 0)
        self.at, self.size = at[by][new], size[by][new]
        pairs = np.unique(np.stack([np.cumsum(new) - 1, item[by]], 1), axis=0) if len(by) else np.zeros((0, 2), np.int64)
        self.member = pairs[:, 1]  # items of window w: from place edge[w] to edge[w + 1]
        self.edge = np.searchsorted(pairs[:, 0], np.arange(len(self.at) + 1))

    def named(self, window: int) -> str:
        """The first item with the window."""
        return self.names[self.member[self.edge[window]]]

    def members(self, windows: np.ndarray) -> list[str]:
        """Sorted names of the items with any of the windows."""
        places = ranges(self.edge[windows], self.edge[windows + 1] - self.edge[windows])
        return sorted({self.names[i] for i in np.unique(self.member[places])})


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` numbers from each of ``first`` on, one list after the other."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(first - before, count)


def run_ranks(tokens: np.ndarray, k: int) -> np.ndarray:
    """For each place a number that is equal for equal runs of ``k`` words (runs over the end: of zeros).

    Ranks of runs of doubled length come from pairs of ranks, so numbers stay below the places' squared.
    """
    rank, size = tokens, 1
    while size < k:
        step = min(size, k - size)
        ahead = np.concatenate([rank[step:], np.zeros(step, np.int64)])
        rank = np.unique(rank * np.int64(int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1].reshape(-1) + 1
        size += step
    return rank


class Leads:
    """The distinct first ``lead`` words of item suffixes, looked up by one sorted table per word."""

    def __init__(self, tokens: np.ndarray, at: np.ndarray, lead: int):
        self.wide = np.int64(int(tokens.max(initial=0)) + 1)
        self.tables: list[np.ndarray] = []
        place = tokens[at]
        for k in range(1, lead):
            word = tokens[at + k]
            at, place, word = at[word > 0], place[word > 0], word[word > 0]
            table, place = np.unique(place * self.wide + word, return_inverse=True)
            self.tables.append(table)
            place = place.reshape(-1)

    def held(self, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Those of ``at`` whose first words begin an item suffix."""
        at = at[tokens[at] > 0]
        place = tokens[at]
        for k, table in enumerate(self.tables, 1):
            word = tokens[at + k]
            code = place * self.wide + word
            place = np.minimum(np.searchsorted(table, code), max(0, len(table) - 1))
            found = (word > 0) & (table[place] == code) if len(table) else np.zeros(len(at), bool)
            at, place = at[found], place[found]
        return at


def suffix_array(tokens: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The places ``at`` in the order of the suffixes that begin there, compared to ``depth`` words.

    Sorts by blocks of three words; after each block only suffixes that are still equal are sorted on.
    """
    order = np.sort(at)
    padded = np.concatenate([tokens, np.zeros(depth + LEAD + 1, np.int64)])
    groups = np.array([[0, len(order)]], np.int64)
    for offset in range(0, depth, LEAD):
        if not len(groups):
            break
        sizes = groups[:, 1] - groups[:, 0]
        place, group = ranges(groups[:, 0], sizes), np.repeat(np.arange(len(groups)), sizes)
        here = order[place] + offset
        key = [padded[here + k] for k in range(LEAD)]
        by = np.lexsort((*key[::-1], group))
        order[place] = order[place][by]
        group = group[by]
        same = group[1:] == group[:-1]
        for k in key:
            same &= k[by][1:] == k[by][:-1]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        groups = np.stack([place[edges[::2]], place[edges[1::2]] + 1], 1)
    return order


def common_prefix(tokens, at, other, start, most) -> np.ndarray:
    """Equal words from ``tokens[at]`` and ``other[start]`` on, at most ``most``; 0 is equal to nothing."""
    out = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    k = 0
    while len(live):
        live = live[k < most[live]]
        a, b = tokens[at[live] + k], other[start[live] + k]
        live = live[(a == b) & (a > 0)]
        out[live] += 1
        k += 1
    return out


def bound(tokens, array, other, start, most, upper: bool) -> np.ndarray:
    """Binary search: for every suffix ``other[start]``, cut to ``most`` words, the first place in the
    suffix array whose suffix is not smaller (``upper``: is larger)."""
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(array), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        at, q, m = array[middle], start[live], most[live]
        k = common_prefix(tokens, at, other, q, m)
        whole = k >= m
        inside = np.where(whole, 0, k)
        below = np.where(whole, upper, tokens[at + inside] < other[q + inside])
        low[live] = np.where(below, middle + 1, low[live])
        high[live] = np.where(below, high[live], middle)


def search_shard(texts: list[bytes | None], items: Items) -> dict[str, list]:
    """Matches of all item suffixes in the suffix array of a shard of whole texts."""
    number, n = items.number, len(texts)
    flat: list[int] = []
    begin = np.zeros(n + 1, np.int64)
    sizes = []
    for i, text in enumerate(texts):
        tokens = words(text)
        sizes.append(len(tokens))
        flat += [number.get(w, 0) for w in tokens]
        flat.append(0)  # no match crosses from a text to the next
        begin[i + 1] = len(flat)
    out = {
        "n_words": sizes,
        "longest": [0] * n,
        "longest_start": [None] * n,
        "longest_item": [None] * n,
        "starts": [[] for _ in range(n)],
        "ends": [[] for _ in range(n)],
        "items": [[] for _ in range(n)],
    }
    if not len(items.start):
        return out
    tokens = np.array([*flat, *[0] * (max(items.longest, LEAD) + 1)], np.int64)
    # Suffixes whose first words begin no item suffix have no match and stay out of the array.
    at = items.leads.held(tokens, np.arange(len(flat)))
    if not len(at):
        return out
    array = suffix_array(tokens, at, items.longest)
    # Longest verbatim match of each item suffix, from the neighbours of its place.
    spot = bound(tokens, array, items.tokens, items.start, items.left, upper=False)
    best = np.zeros(len(spot), np.int64)
    for shift in (-1, 0):
        near = spot + shift
        ok = np.flatnonzero((near >= 0) & (near < len(array)))
        length = common_prefix(tokens, array[near[ok]], items.tokens, items.start[ok], items.left[ok])
        best[ok] = np.maximum(best[ok], length)
    # Windows that some suffix matches in full, with all their places.
    reach, left = np.zeros(len(items.tokens), np.int64), np.zeros(len(items.tokens), np.int64)
    reach[items.start], left[items.start] = best, items.left
    live = np.flatnonzero(reach[items.at] >= items.size)
    if not len(live):
        return out
    low = bound(tokens, array, items.tokens, items.at[live], items.size[live], upper=False)
    high = bound(tokens, array, items.tokens, items.at[live], items.size[live], upper=True)
    count = high - low
    window = np.repeat(live, count)
    first = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    found = array[first + np.arange(len(window))]
    doc = np.searchsorted(begin, found, "right") - 1
    length = common_prefix(tokens, found, items.tokens, items.at[window], left[items.at[window]])
    order = np.lexsort((found, doc))
    edges = np.flatnonzero(np.diff(np.concatenate([[-1], doc[order], [-1]])))
    for a, b in zip(edges[:-1], edges[1:]):
        rows = order[a:b]
        d = int(doc[rows[0]])
        s = found[rows] - begin[d]
        most = int(np.argmax(length[rows]))
        out["longest"][d] = int(length[rows[most]])
        out["longest_start"][d] = int(s[most])
        out["longest_item"][d] = items.named(int(window[rows[most]]))
        out["starts"][d], out["ends"][d] = merge_spans(s, s + items.size[window[rows]])
        out["items"][d] = items.members(np.unique(window[rows]))
    return out


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Disjoint spans that cover the same words."""
    order = np.argsort(starts, kind="stable")
    starts, ends = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new].tolist(), ends[last].tolist()


def item_slices(
    benchmark: DataFrame, item_id: str, text: str, slice_bytes: int
) -> Iterator[list[tuple[str, bytes | None]]]:
    """Items in lists that end with the item that fills ``slice_bytes`` of text, read from Spark one by one."""
    held, size = [], 0
    rows = benchmark.select(
        F.coalesce(column(item_id).cast("string"), F.lit("")).alias("id"),
        column(text).cast("binary").alias("text"),
    )
    for row in rows.toLocalIterator():
        held.append((row["id"], bytes(row["text"]) if row["text"] is not None else None))
        size += len(held[-1][1] or b"")
        if size >= slice_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
    keep: list[str] | None = None,
    result: str = "match",
) -> DataFrame:
    """Rows with a struct ``result``: what of each whole text stands verbatim in the benchmark.

    ``n_words``; ``longest``, ``longest_start`` and ``longest_item``: the longest verbatim match that
    begins with a window, followed in the first item that has the window (0 and null without a
    window; the leftmost of equal ones); ``starts`` and ``ends``: disjoint spans of words inside any occurrence of a window
    (``window`` consecutive item words; a shorter item is one window); ``items``: sorted ids of the
    items with an occurring window. Null and empty texts have no words and no matches; items without
    words are no items; a null item id counts as the empty string; equal item ids are one item.

    Clashing column names are kept and ``result`` renamed; repeated rows stay rows; an empty table
    gives an empty result. Texts and items of any length and number of distinct words are compared whole.

    A map over the texts: they are never shuffled. A worker builds the arrays of a slice once. A
    benchmark of several slices (``slice_bytes`` of text each) is searched slice by slice: rows are
    numbered and stored, each slice's matches are stored before the next slice is read, and matches are
    gathered by row. So the driver and a task hold one slice.
    """
    keep = docs.columns if keep is None else keep
    name = free_name(docs, result)
    carried = [*keep, *([] if text in keep else [text])]
    out = docs.select(*[column(c) for c in carried])
    slices = item_slices(benchmark, item_id, item_text, slice_bytes)
    part, following = next(slices, []), next(slices, None)
    if following is None:
        return annotate(out, text, _searcher(out.sparkSession, part, window), RESULT, name, keep)
    row, found = free_name(out, "row"), None
    stored = checkpoint(out.withColumn(row, F.monotonically_increasing_id()))
    while part is not None:
        mine = annotate(stored, text, _searcher(out.sparkSession, part, window), RESULT, name, [row])
        if found is not None:  # the first slice tells the number of words of every row
            mine = mine.where(F.size(column(name)["starts"]) > 0)
        mine = checkpoint(mine)
        found = mine if found is None else found.unionByName(mine)
        part, following = following, next(slices, None)
    merged = _merged(found, row, name)
    return stored.join(merged, row).select(*[column(c) for c in keep], column(name))


_BUILT: dict[str, Items] = {}  # the slice that this worker last searched


def _searcher(spark: SparkSession, part: list[tuple[str, bytes | None]], window: int):
    """Searches batches for one slice; it reaches a worker once, as a broadcast of bounded size."""
    sent, key = spark.sparkContext.broadcast(part), uuid.uuid4().hex

    def make():
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Items(sent.value, window)
        items = _BUILT[key]
        return lambda texts: search_shard(texts, items)

    return make


def _merged(found: DataFrame, row: str, name: str) -> DataFrame:
    """One result per row from those of several benchmark slices (at most one of each)."""
    gathered = found.groupBy(column(row)).agg(F.collect_list(column(name)).alias(name))
    schema = T.StructType([gathered.schema[row], T.StructField(name, RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [merge_matches(parts) for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, batch.schema.field(1).type.value_type)], names=[row, name]
            )

    return gathered.mapInArrow(run, schema)


def merge_matches(parts: list[dict]) -> dict:
    """One match from those of several slices: spans united, the longest, then leftmost match kept."""
    best = max(parts, key=lambda p: (p["longest"], -(p["longest_start"] or 0), p["longest_item"] or ""))
    starts, ends = (np.array([x for p in parts for x in p[c]], np.int64) for c in ("starts", "ends"))
    united = merge_spans(starts, ends) if len(starts) else ([], [])
    return best | {"starts": united[0], "ends": united[1], "items": sorted({i for p in parts for i in p["items"]})}


def hit_words(match):
    """Words of a text inside any occurrence of a window."""
    return F.aggregate(
        F.arrays_zip(match["starts"].alias("s"), match["ends"].alias("e")),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x["e"] - x["s"],
    )


def is_contaminated(match):
    """A twentieth of the words at least, and one at least, stand in a benchmark window."""
    n = hit_words(match)
    return (n > 0) & (20 * n >= match["n_words"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without contaminated rows; columns stay. See ``find_matches``."""
    name = free_name(docs, "match")
    matched = find_matches(docs, benchmark, result=name, **how)
    return matched.where(~is_contaminated(column(name))).drop(name)


def contamination_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with its counts, the digest of its items, and the verdict."""
    matched = find_matches(docs.select("doc_id", "text"), benchmark, keep=["doc_id"], result="match")
    match = F.col("match")
    return matched.select(
        "doc_id",
        match["n_words"].alias("n_words"),
        hit_words(match).alias("n_hit"),
        F.size(match["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(match["items"], ","), 256).alias("items_sha256"),
        is_contaminated(match).alias("contaminated"),
    )


