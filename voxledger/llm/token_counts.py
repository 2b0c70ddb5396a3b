"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A text is never turned into identifiers: its count is the number of initial symbols minus the number
of merges. Initial symbols are characters; one that the vocabulary lacks counts as its UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import annotate, free_name

SPACE = "▁"  # stands for U+0020 in the vocabulary
CACHED_WORDS = 300_000  # distinct words in each of a worker's three memories, about 100 MB
CACHED_LENGTH = 64  # longer words are counted each time they occur

RESULT = T.StructType(
    [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
)


@dataclass(frozen=True)
class PieceVocabulary:
    """Ranks of the pieces of a BPE vocabulary with byte fallback; a lower rank merges first."""

    ranks: dict[str, int] = field(repr=False)

    @staticmethod
    def load(path: str) -> PieceVocabulary:
        """Read the pieces of a ``.model`` file on the driver; its size is fixed (32,000 pieces).

        Only plain pieces take part in merging: control, unknown and byte pieces stand for no text.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ranks = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                ranks[model.id_to_piece(i)] = -model.get_score(i)
        order = {s: n for n, s in enumerate(sorted(set(ranks.values())))}
        return PieceVocabulary({piece: order[s] for piece, s in ranks.items()})

    def splits_before_space(self) -> bool:
        """True if no piece has a space after another character: words can then be merged apart."""
        return not any(SPACE in piece.lstrip(SPACE) for piece in self.ranks)

    def lone(self, character: str) -> bool:
        """True if ``character`` is in no piece together with another one."""
        return not any(character in piece and len(piece) > 1 for piece in self.ranks)


def merge_count(word: str, ranks: dict[str, int]) -> int:
    """Tokens of ``word``: initial symbols minus merges, the lowest rank first, then the leftmost.

    The symbols form a linked list; the heap holds rank, position and length of adjacent pairs in one
    integer each. An entry is stale if either symbol has changed since, which its length tells. A
    character that stays alone and is not in the vocabulary counts as its bytes.
    """
    n = len(word)
    bits = n.bit_length()
    mask = (1 << bits) - 1
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    heap = []
    for i in range(n - 1):
        rank = get(word[i : i + 2])
        if rank is not None:
            heap.append(((rank << bits) | i) << bits | 2)
    size = [1] * n  # characters of the symbol that starts here; 0: merged away
    count = n
    if heap:
        heapq.heapify(heap)
        before = list(range(-1, n))
        while heap:
            entry = pop(heap)
            length = entry & mask
            i = (entry >> bits) & mask
            left = size[i]
            j = i + left
            if not left or j >= n or left + size[j] != length:
                continue
            count -= 1
            size[i], size[j] = length, 0
            after = i + length
            if after < n:
                before[after] = i
                joined = length + size[after]
                rank = get(word[i : i + joined])
                if rank is not None:
                    push(heap, ((rank << bits) | i) << bits | joined)
            k = before[i]
            if k >= 0:
                joined = size[k] + length
                rank = get(word[k : k + joined])
                if rank is not None:
                    push(heap, ((rank << bits) | k) << bits | joined)
    for c, s in zip(word, size):
        if s == 1 and c not in ranks:
            count += len(c.encode()) - 1
    return count


class _Counter(dict):
    """Tokens per word (UTF-8 with the space before it), filled as words occur.

    A word is cut between two characters that stand side by side in no piece, as no merge joins
    them; words that differ in a comma then share their parts. Of the remembered words, those not
    used since the last time the memory was full are forgotten.
    """

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks
        self.pairs = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        self.old: dict[bytes, int] = {}
        self.parts: dict[str, int] = {}

    def __missing__(self, word: bytes) -> int:
        count = self.old.get(word)
        if count is None:
            count = self._count(word.decode("utf-8", "replace"))
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = count
        return count

    def _count(self, word: str) -> int:
        pairs, total, start = self.pairs, 0, 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in pairs:
                total += self._part(word[start:i])
                start = i
        return total + self._part(word[start:])

    def _part(self, part: str) -> int:
        count = self.parts.get(part)
        if count is None:
            count = merge_count(part, self.ranks)
            if len(part) <= CACHED_LENGTH:
                if len(self.parts) >= CACHED_WORDS:
                    self.parts.clear()
                self.parts[part] = count
        return count


def text_counter(vocabulary: PieceVocabulary):
    """A function from UTF-8 bytes to the token count of the whole text.

    The text gets a space before it and is cut where a space follows another character: no piece
    reaches across such a place, so no merge does. Line breaks are cut out too when they are in no
    longer piece. A vocabulary without these properties is merged uncut.
    """
    counts = _Counter(vocabulary.ranks)
    space = SPACE.encode()
    if not vocabulary.splits_before_space():
        return lambda text: counts[space + text.replace(b" ", space)] if text else 0
    breaks = vocabulary.lone("\n") and "\n" not in vocabulary.ranks
    chunk = re.compile(rb"(?:\xe2\x96\x81)*(?:(?!\xe2\x96\x81)[\s\S])+|(?:\xe2\x96\x81)+")
    get = counts.__getitem__

    def count(text: bytes) -> int:
        if not text:
            return 0
        total = 0
        if breaks and b"\n" in text:
            # A line break is one byte token and ends a word on both sides.
            lines = text.split(b"\n")
            total += len(lines) - 1
        else:
            lines = [text]
        for at, line in enumerate(lines):
            if at == 0:
                line = b" " + line
            if not line:
                continue
            if b"  " in line or space in line or line[-1:] == b" ":
                total += sum(map(get, chunk.findall(line.replace(b" ", space))))
            else:
                parts = line.split(b" ")
                head = parts[0]
                if head:
                    total += get(head)
                if len(parts) > 1:
                    total += sum(map(get, [space + w for w in parts[1:]]))
        return total

    return count


def count_tokens(
    docs: DataFrame,
    vocabulary: PieceVocabulary,
    *,
    text: str = "text",
    keep: list[str] | None = None,
    result: str = "tokens",
) -> DataFrame:
    """Rows with a struct ``result`` of ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each. An input column
    called like ``result`` makes the new one get underscores in front. The vocabulary has a fixed
    size and travels with the function. A map: no shuffle.
    """
    name = free_name(docs, result)

    def make():
        count = text_counter(vocabulary)

        def compute(texts):
            texts = [t or b"" for t in texts]
            return {"n_bytes": [len(t) for t in texts], "n_tokens": [count(t) for t in texts]}

        return compute

    return annotate(docs, text, make, RESULT, name, keep)


def token_table(docs: DataFrame, vocabulary: PieceVocabulary, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    counted = count_tokens(docs.select("doc_id", "text"), vocabulary, keep=["doc_id"], result="tokens")
    return counted.select(
        "doc_id",
        F.col("tokens.n_bytes").alias("n_bytes"),
        F.col("tokens.n_tokens").alias("n_tokens"),
        (F.col("tokens.n_tokens") > limit).alias("over_limit"),
    )
