"""Secret scans with corpus-wide ownership frequency.

Candidates are found by pattern in each text. Every candidate value is hashed, and the hashes are
counted over the whole corpus by distinct repositories and distinct owners. A value that many owners
carry is a copied example, and so is one in very many repositories of one owner; the others are
credentials of their owner.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import annotate, checkpoint, column, free_name

# Base kinds and their patterns, in the order of the contract.
BASE_KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

# Further shapes of credentials. They count as secrets only if their owner is alone.
SHAPES = [
    ("forge", r"\bgh[pousr]_[A-Za-z0-9]{30,}", "gh"),
    ("service", r"\b[sr]k[-_](?:live[-_])?[A-Za-z0-9]{20,}", "k"),
    ("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    ("signed", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    ("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\t\n\r ]+", "-----BEGIN"),
]
_SHAPES = [(kind, re.compile(pattern, re.ASCII), hint) for kind, pattern, hint in SHAPES]

MAX_OWNERS, MAX_REPOSITORIES = 2, 100  # beyond either, a value is a copied example
SECRET, EXAMPLE = "[SECRET]", "[EXAMPLE]"

# A text with any candidate fits this.
MAY_HOLD = (
    r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
    r"|gh[pousr]_|[sr]k[-_]|xox[abprs]-|eyJ|-----BEGIN"
)

_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_HEX_BYTES = bytes(120 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))
_RUN = b"x" * HEX_LENGTH

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("value_hash", T.StringType()),
        T.StructField("inside", T.BooleanType()),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("base", T.ArrayType(SPAN)),
        T.StructField("shaped", T.ArrayType(SPAN)),
    ]
)


def find_base(raw: bytes) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds in a whole text, in code points, by start and kind.

    A quick look at the bytes first says which kinds can occur at all.
    """
    low = raw.lower()
    assign = any(k.encode() in low for k in _KEYWORDS)
    access = b"AKIA" in raw
    hexes = _RUN in raw.translate(_HEX_BYTES)
    if not (assign or access or hexes):
        return []
    text = raw.decode("utf-8", "replace")
    out = []
    if assign:
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if access:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    if hexes:
        out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def find_shaped(raw: bytes) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the further shapes in a whole text."""
    live = [(kind, pattern) for kind, pattern, hint in _SHAPES if hint.encode() in raw and (kind != "service" or b"sk" in raw or b"rk" in raw)]
    if not live:
        return []
    text = raw.decode("utf-8", "replace")
    return sorted(
        ((kind, m.start(), m.end(), m[0]) for kind, pattern in live for m in pattern.finditer(text)),
        key=lambda s: (s[1], s[2]),
    )


def find_candidates(
    docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, result: str = "found"
) -> DataFrame:
    """Rows with a struct ``result`` of ``base`` and ``shaped`` spans; a map over whole texts.

    A shaped span that a base span covers is marked ``inside``.
    """
    name = free_name(docs, result)

    def make() -> Callable:
        def spans(found, base):
            hidden = inside(found, base)
            return [
                {"kind": k, "start": s, "end": e, "value_hash": hashlib.sha256(v.encode()).hexdigest(), "inside": h}
                for (k, s, e, v), h in zip(found, hidden)
            ]

        def compute(texts):
            out = {"base": [], "shaped": []}
            for t in texts:
                base, shaped = (find_base(t), find_shaped(t)) if t else ([], [])
                out["base"].append(spans(base, []))
                out["shaped"].append(spans(shaped, base))
            return out

        return compute

    return annotate(docs, text, make, RESULT, name, keep)


def inside(spans: list[tuple], base: list[tuple]) -> list[bool]:
    """For each span whether a base span covers it; both are sorted by start, so one sweep tells."""
    out, reach, at = [], -1, 0
    for _, start, end, _ in spans:
        while at < len(base) and base[at][1] <= start:
            reach = max(reach, base[at][2])
            at += 1
        out.append(reach >= end)
    return out


def ownership(spans: DataFrame, repository: str = "repository", owner: str = "owner") -> DataFrame:
    """Distinct repositories and owners per ``value_hash``.

    Counted from distinct (value, repository) and (value, owner) pairs, which shrink before they
    move, so a value in a third of all rows needs no large group. A null owner or repository counts
    as one more.
    """
    pairs = (
        spans.select(
            "value_hash",
            F.explode(
                F.array(
                    F.struct(F.lit("repository").alias("what"), F.col(repository).cast("string").alias("who")),
                    F.struct(F.lit("owner").alias("what"), F.col(owner).cast("string").alias("who")),
                )
            ).alias("p"),
        )
        .select("value_hash", F.col("p.what").alias("what"), F.col("p.who").alias("who"))
        .distinct()
    )
    return pairs.groupBy("value_hash").agg(
        F.count_if(F.col("what") == "repository").alias("n_repositories"),
        F.count_if(F.col("what") == "owner").alias("n_owners"),
    )


def scan_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
    max_repositories: int | None = MAX_REPOSITORIES,
    copied: bool = False,
) -> DataFrame:
    """One row per input row: ``row``, ``id_col``, and all ``spans`` with what the corpus says of them.

    A span has kind, start, end (code points, end exclusive), value_hash, base, n_repositories,
    n_owners and live. ``live`` is true for a value that at most ``max_owners`` owners and (if not None)
    ``max_repositories`` repositories carry: a widely copied example is not, though one owner may hold
    all its copies. Base spans always stay,
    whether live or not; spans of further shapes are added if live, or with ``copied`` also if not,
    and not inside a base span of the same document. ``row`` numbers the
    input rows, so repeated rows and ids stay apart. Null and empty texts have no spans; a null
    owner is one owner. Extra columns are not looked at.

    Texts are read once and never moved: only candidates are shuffled, and the few that a text has
    are gathered again by row number.
    """
    source = docs.select(
        column(id_col).alias("id"),
        column(text).alias("text"),
        column(repository).cast("string").alias("repository"),
        column(owner).cast("string").alias("owner"),
    )
    found = checkpoint(
        find_candidates(source, keep=["id", "repository", "owner"], result="found").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    spans = found.select(
        "row",
        "repository",
        "owner",
        F.explode(
            F.concat(
                F.transform("found.base", lambda s: F.struct(*_fields(s), F.lit(True).alias("base"))),
                F.transform("found.shaped", lambda s: F.struct(*_fields(s), F.lit(False).alias("base"))),
            )
        ).alias("s"),
    ).select("row", "repository", "owner", "s.*")
    counts = ownership(spans)
    live = F.col("n_owners") <= max_owners
    if max_repositories is not None:
        live = live & (F.col("n_repositories") <= max_repositories)
    judged = spans.where(~F.col("inside")).drop("repository", "owner", "inside")
    judged = judged.join(counts, "value_hash").withColumn("live", live)
    if not copied:
        judged = judged.where(F.col("base") | F.col("live"))
    gathered = judged.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct("start", _rank(F.col("kind")).alias("rank"), "kind", "end", "value_hash", "base", "n_repositories", "n_owners", "live")
            )
        ).alias("spans")
    )
    return (
        found.select("row", F.col("id").alias(id_col))
        .join(gathered, "row", "left")
        .withColumn("spans", F.coalesce("spans", F.array().cast(gathered.schema["spans"].dataType)))
    )


def _fields(s):
    return [s[f].alias(f) for f in ("kind", "start", "end", "value_hash", "inside")]


def _rank(kind):
    order = [*BASE_KINDS, *[k for k, _, _ in SHAPES]]
    return F.array_position(F.array(*[F.lit(k) for k in order]), kind)


def secret_table(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document."""
    scanned = scan_secrets(docs)
    base = F.filter("spans", lambda s: s["base"])
    text_of = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def mask_secrets(
    docs: DataFrame,
    *,
    text: str = "text",
    n_chars: str | None = None,
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
    max_repositories: int | None = MAX_REPOSITORIES,
    copied: bool = False,
) -> DataFrame:
    """Rows of ``docs`` with the secrets in ``text`` masked; all columns and rows stay.

    A live credential becomes ``[SECRET]``, a base span that is a widely copied example becomes
    ``[EXAMPLE]``, with ``copied`` also a span of a further shape; overlapping spans become one mask, ``[SECRET]`` if any is live. ``n_chars`` names a
    column to set to the new length. Texts without spans come back as they are, null texts too.

    A pattern that every candidate fits divides the rows: those without stay in their tasks. The
    others are kept at a checkpoint; their spans are kept per distinct text and meet it by an equality
    join.
    """
    may = F.coalesce(column(text).rlike(MAY_HOLD), F.lit(False))
    key, found = free_name(docs, "text_key"), free_name(docs, "text_spans")
    rest = docs.where(~may)
    some = checkpoint(docs.where(may).withColumn(key, F.sha2(column(text).cast("binary"), 256)))
    scanned = scan_secrets(
        some, id_col=key, text=text, repository=repository, owner=owner, max_owners=max_owners, max_repositories=max_repositories, copied=copied
    )
    spans = scanned.where(F.size("spans") > 0).groupBy(column(key)).agg(
        F.first(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["live"]))).alias(found)
    )
    joined = some.join(spans, key, "left")
    out = _masked(joined, text, found)
    if n_chars:
        hit = column(found).isNotNull()
        out = out.withColumn(n_chars, F.when(hit, F.char_length(column(text)).cast("long")).otherwise(column(n_chars)))
    return rest.unionByName(out.select(*[column(c) for c in docs.columns]))


def _masked(rows: DataFrame, text: str, found: str) -> DataFrame:
    """``rows`` with ``text`` masked at the spans in ``found``; a map over the rows that can hold secrets."""
    at, spans_at = rows.columns.index(text), rows.columns.index(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()
            made = [mask_text(t, [tuple(s.values()) for s in found_]) if found_ else t for t, found_ in zip(texts, spans)]
            columns = list(batch.columns)
            columns[at] = pa.array(made, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return rows.mapInArrow(run, rows.schema)


def mask_text(text: str, spans: list[tuple[int, int, bool]]) -> str:
    """``text`` with spans (start, end, live; sorted by start) replaced; overlapping ones are one mask.

    One sweep: the text is cut at each mask once and joined once.
    """
    pieces, at = [], 0
    for start, end, live in _united(spans):
        pieces += [text[at:start], SECRET if live else EXAMPLE]
        at = end
    return "".join([*pieces, text[at:]])


def _united(spans: list[tuple[int, int, bool]]) -> Iterator[tuple[int, int, bool]]:
    held = None
    for start, end, live in spans:
        if held is not None and held[1] > start:
            held = (held[0], max(held[1], end), held[2] or live)
            continue
        if held is not None:
            yield held
        held = (start, end, live)
    if held is not None:
        yield held
