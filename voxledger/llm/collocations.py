"""Phrase collocations: best-first branch-and-bound growth of phrases from their prefixes.

Words are counted first, then the pairs of words that are frequent, then, in rounds, longer phrases.
A phrase ``p`` grown by one word keeps the cut after its first word, so its score is at most
``f(p) / f(first word)``; the same holds from its other end. Each round opens the branches whose bound
reaches a cutoff, and those that may hold a better phrase inside a longer one; when a language has
enough surviving phrases at or above the cutoff, nothing unopened can be among its first ones, ties
included, and it is settled. Else its cutoff falls and the next round opens more.

Counting is a map that adds up within tasks; what it leaves out is told by tables of bits of a fixed
size, so the frontier that is sent to tasks never grows with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import checkpoint, column

TOP = 2000
LEAST = 10  # occurrences of a candidate
INSIDE_PERCENT = 50  # of its occurrences inside a longer candidate drop a phrase
SCALE = 1_000_000
BITS = 25  # log2 of the bits of a filter: 4 MB
FLUSH_WORDS = 2_500_000  # words (and distinct words) that a task holds before it passes counts on
SLICE = 4 << 20  # bytes of a text that are split at a time
WIDEN = 4  # how much further down the ranks of pairs the next round's cutoff goes
UNKNOWN = "und"

MARK = 0xFF  # ends a piece; in no UTF-8 text
#: A-Z in lower case; characters that end a piece become the mark, blanks stay.
PIECES = bytes(
    MARK if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b in b"\x20\x09" else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_GAP = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")


def text_tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of the whole text and a mark where a piece ends, in slices cut between words.

    The last slice ends with a mark.
    """
    mark = bytes([MARK])
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + SLICE) if at + SLICE < len(text) else None
        stop = gap.start() if gap else len(text)
        part = text[at:stop].translate(PIECES)
        # Only blanks (0x20) and marks are left of what parts words; other control characters are letters.
        yield [w for w in part.replace(mark, b" " + mark + b" ").split(b" ") if w]
        at = stop
    yield [mark]


class Numbers(dict):
    """Numbers of a language's words, from 1 in the order of appearance; 0 is the mark."""

    def __init__(self) -> None:
        super().__init__({bytes([MARK]): 0})
        self.words: list[bytes] = [bytes([MARK])]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def slots(first: np.ndarray, second: np.ndarray | None = None, bits: int = BITS) -> np.ndarray:
    """Place in a filter of a word's hash, or of a pair of words' hashes."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15)
    if second is not None:
        mixed = (mixed ^ mixed >> np.uint64(29)) + second * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b" " + word)


def bit_filter(rows: DataFrame, columns: list[str], bits: int = BITS) -> np.ndarray:
    """Bits (as bytes) at the ``slots`` of ``lang`` and the word columns of all rows.

    What comes to the driver are 4 KB bitmaps, at most ``2^bits`` bits in all, whatever the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [c.to_pylist() for c in batch.columns]
            hashes = [
                np.array([word_hash(lang, w.encode()) for lang, w in zip(values[0], v)], np.uint64) for v in values[1:]
            ]
            # Spark's bitmap functions count from 1.
            yield pa.RecordBatch.from_arrays([pa.array(slots(*hashes, bits=bits) + 1)], names=["slot"])

    found = (
        rows.select("lang", *columns)
        .mapInArrow(run, "slot long")
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
        .collect()
    )
    out = np.zeros(max(4096, 1 << bits - 3), np.uint8)
    for row in found:
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(row["bitmap"]), np.uint8)
    return out


def _has(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the filter has the bit of each slot."""
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


class Counter:
    """Counts runs of ``order`` words of one language in a task."""

    def __init__(self, lang: str, order: int):
        self.lang, self.order = lang, order
        self.numbers = Numbers()
        self.hashes: list[int] = []
        self.parts: list[np.ndarray] = []

    def add(self, tokens: list[bytes]) -> int:
        """Hold tokens; returns by how much what is held has grown."""
        known = len(self.numbers)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens)))
        return len(tokens) + len(self.numbers) - known

    def tail(self) -> list[bytes]:
        """The last words, which a run that goes on in the next slice begins with."""
        last = self.parts[-1][-(self.order - 1) :] if self.order > 1 and self.parts else ()
        return [self.numbers.words[i] for i in last]

    def word_hashes(self) -> np.ndarray:
        words = self.numbers.words
        self.hashes.extend(word_hash(self.lang, w) for w in words[len(self.hashes) :])
        return np.array(self.hashes, np.uint64)

    def take(self, filters: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Runs (word numbers in rows) and their counts; forgets all that was held."""
        codes = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        if self.order == 1:
            counts = np.bincount(codes, minlength=len(self.numbers))
            runs = np.flatnonzero(counts[1:])[:, None] + 1
            return runs, counts[1:][runs[:, 0] - 1]
        hashes = self.word_hashes()
        wide = np.int64(len(self.numbers))
        if self.order == 2:
            (frequent,) = filters
            open_ = _has(frequent, slots(hashes))
            open_[0] = False
            live = open_[codes[:-1]] & open_[codes[1:]]
            pairs, counts = np.unique(codes[:-1][live] * wide + codes[1:][live], return_counts=True)
            return np.stack([pairs // wide, pairs % wide], 1), counts
        prefixes, suffixes, winners = filters
        whole = (codes[:-1] > 0) & (codes[1:] > 0)
        pairs, place = np.unique(codes[:-1] * wide + codes[1:], return_inverse=True)
        at = slots(hashes[pairs // wide], hashes[pairs % wide])
        in_prefix, in_suffix, wins = (_has(f, at)[place] & whole for f in (prefixes, suffixes, winners))
        live = (in_prefix[:-1] & in_suffix[1:] | wins[:-1] & whole[1:] | whole[:-1] & wins[1:])
        # A pair's place is under the number of pairs, a word's under ``wide``: their product fits.
        runs, counts = np.unique(place[:-1][live] * wide + codes[2:][live], return_counts=True)
        first = pairs[runs // wide]
        return np.stack([first // wide, first % wide, runs % wide], 1), counts


def count_runs(
    docs: DataFrame, order: int, filters: tuple[np.ndarray, ...] = (), flush_words: int = FLUSH_WORDS
) -> DataFrame:
    """``lang``, ``w1``... and ``n``: occurrences within pieces of runs of ``order`` words that pass the filters.

    A task adds up per ``flush_words`` words, then counts are summed by run. Runs that a filter leaves out
    have no row; some that it should leave out may have one, with their right count.
    """
    names = [f"w{i}" for i in range(1, order + 1)]
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), *[T.StructField(n, T.StringType()) for n in names], T.StructField("n", T.LongType())]
    )
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in counters.items():
                runs, counts = counter.take(sent.value)
                words = pa.array(counter.numbers.words, pa.binary())
                for at in range(0, len(runs), 65_536):
                    part = runs[at : at + 65_536]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            *[words.take(pa.array(part[:, k])).cast(pa.string()) for k in range(order)],
                            pa.array(counts[at : at + 65_536], pa.int64()),
                        ],
                        names=["lang", *names, "n"],
                    )
            counters.clear()

        held = 0
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for lang, text in zip(batch.column(1).to_pylist(), texts):
                for tokens in text_tokens(text.as_py()):
                    held += counters.setdefault(lang, Counter(lang, order)).add(tokens)
                    if held >= flush_words:
                        tail = counters[lang].tail()
                        yield from flush()
                        counters[lang] = Counter(lang, order)
                        held = counters[lang].add(tail)
        yield from flush()

    counted = docs.mapInArrow(run, schema)
    return counted.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def score(a: Column, left: Column, right: Column, scale: int = SCALE) -> Column:
    """``floor(scale a a / (left right))``, exact: products are decimals of up to 38 digits."""
    wide = lambda c: c.cast("decimal(15,0)")
    over = (wide(a) * wide(a) * F.lit(scale).cast("decimal(8,0)")).cast("decimal(38,0)")
    return F.call_function("div", over, (wide(left) * wide(right)).cast("decimal(38,0)")).cast("long")


def part_of(a: Column, whole: Column, scale: int = SCALE) -> Column:
    """``floor(scale a / whole)``: the bound of a branch that keeps a cut with ``whole`` on one side."""
    over = (a.cast("decimal(18,0)") * F.lit(scale).cast("decimal(8,0)")).cast("decimal(38,0)")
    return F.call_function("div", over, whole.cast("decimal(38,0)")).cast("long")


def _cutoffs(pairs: DataFrame, rank: int) -> DataFrame:
    """``lang`` and ``cutoff``: a score that at least ``rank`` pairs of the language reach, else 0.

    Scores are whole and at most ``SCALE``, so a histogram of a thousand steps per language is
    all that is sorted.
    """
    step = (F.col("score") / F.lit(SCALE // 1000)).cast("int")
    histogram = pairs.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n"))
    down = Window.partitionBy("lang").orderBy(F.desc("step"))
    reached = histogram.withColumn("above", F.sum("n").over(down))
    return reached.groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("above") >= rank, F.col("step"))) * (SCALE // 1000), F.lit(0)).cast("long").alias("cutoff")
    )


def _grown(triples: DataFrame, pairs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Triples that are candidates, with both cuts' counts and their score."""
    side = lambda p, a, b, n: pairs.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("n").alias(n))
    ends = lambda a, n: words.select("lang", F.col("w1").alias(a), F.col("n").alias(n))
    joined = (
        triples.where(F.col("n") >= least)
        .withColumnRenamed("n", "a")
        .join(side(pairs, "w1", "w2", "n12"), ["lang", "w1", "w2"])
        .join(side(pairs, "w2", "w3", "n23"), ["lang", "w2", "w3"])
        .join(ends("w1", "n1"), ["lang", "w1"])
        .join(ends("w3", "n3"), ["lang", "w3"])
    )
    early, late = score(F.col("a"), F.col("n1"), F.col("n23")), score(F.col("a"), F.col("n12"), F.col("n3"))
    cut = F.when(F.col("early") <= F.col("late"), F.struct(F.col("n1").alias("l"), F.col("n23").alias("r"))).otherwise(
        F.struct(F.col("n12").alias("l"), F.col("n3").alias("r"))
    )
    return joined.withColumns({"early": early, "late": late}).select(
        "lang", "w1", "w2", "w3", "a", cut["l"].alias("l"), cut["r"].alias("r"), F.least("early", "late").alias("score")
    )


def _survivors(pairs: DataFrame, triples: DataFrame, percent: int) -> DataFrame:
    """Pairs that no triple drops, and triples: ``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score``.

    A pair goes if ``100 f(longer) >= percent a`` for a candidate triple that begins or ends with it.
    """
    inner = triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    most = inner.groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    kept = pairs.join(most, ["lang", "w1", "w2"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(percent) * F.col("n"))
    )
    phrase = lambda *w: F.concat_ws(" ", *w).alias("phrase")
    return kept.select("lang", phrase("w1", "w2"), F.col("n").alias("a"), "l", "r", "score").unionByName(
        triples.select("lang", phrase("w1", "w2", "w3"), "a", "l", "r", "score")
    )


def top_phrases(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    top: int = TOP,
    least: int = LEAST,
    inside_percent: int = INSIDE_PERCENT,
    flush_words: int = FLUSH_WORDS,
) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n`` and ``score``.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts at its lowest-scoring cut, ``n`` the words
    of the language. Order is by score, then ``a``, both descending, then the phrase's bytes. A null
    ``lang`` is ``und``; null, empty and blank texts have no words; repeated rows count again. A language
    without phrases has no row, an empty table gives an empty result. Other columns, clashing ones too, are
    not read. Very long texts are split in slices between words.

    The rounds read the texts again; each opens ``WIDEN`` times as many ranks as the one before, for the
    languages that are not settled, until all branches are open.
    """
    source = docs.select(
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(column(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
    )
    counted = checkpoint(count_runs(source, 1, flush_words=flush_words))
    words = counted.where(F.col("n") >= least)
    frequent = bit_filter(words, ["w1"])
    ends = lambda a, n: words.select("lang", F.col("w1").alias(a), F.col("n").alias(n))
    pairs = checkpoint(
        count_runs(source, 2, (frequent,), flush_words)
        .where(F.col("n") >= least)
        .join(ends("w1", "l"), ["lang", "w1"])
        .join(ends("w2", "r"), ["lang", "w2"])
        .withColumns(
            {
                "score": score(F.col("n"), F.col("l"), F.col("r")),
                "grow_right": part_of(F.col("n"), F.col("l")),
                "grow_left": part_of(F.col("n"), F.col("r")),
            }
        )
    )
    rank, settled = 2 * top, None
    todo = pairs.select("lang").distinct()
    while True:
        cutoffs = checkpoint(_cutoffs(pairs, rank).join(todo, "lang", "left_semi"))
        frontier = pairs.join(cutoffs, "lang")
        opened = [frontier.where(F.col(c) >= F.col("cutoff")) for c in ("grow_right", "grow_left", "score")]
        triples = count_runs(source, 3, tuple(bit_filter(o, ["w1", "w2"]) for o in opened), flush_words)
        found = _survivors(frontier.where(F.col("score") >= F.col("cutoff")), _grown(triples, pairs, words, least), inside_percent)
        # Below the cutoff not every branch was opened: those phrases are not told yet.
        found = checkpoint(
            found.join(cutoffs, "lang").where(F.col("score") >= F.col("cutoff")).drop("cutoff")
        )
        enough = found.groupBy("lang").agg(F.count("*").alias("found"))
        done = checkpoint(
            cutoffs.join(enough, "lang", "left").where((F.col("cutoff") == 0) | (F.col("found") >= top)).select("lang")
        )
        part = found.join(done, "lang", "left_semi")
        settled = part if settled is None else settled.unionByName(part)
        todo = checkpoint(todo.join(done, "lang", "left_anti"))
        if todo.isEmpty():
            break
        rank *= WIDEN
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    first = settled.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocation_table(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    return top_phrases(docs)
