"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random
import re
from pathlib import Path


DOCS = "doc_id long, text string, lang string, source string, n_chars long"

def made_names() -> list[str]:
    """The names that the operators give to columns, as their sources have them."""
    found = set()
    for path in (Path(__file__).parents[2] / "voxledger" / "llm").glob("*.py"):
        code = path.read_text()
        found.update(re.findall(r"""(?:alias|withColumn|withColumnRenamed|StructField)\("(\w+)\"""", code))
        for call in re.findall(r"free_name\([^()]*\)", code):
            found.update(re.findall(r'"(\w+)"', call))
    return sorted(found - set(re.findall(r"(\w+) (?:long|string)", DOCS)))


#: Columns whose names clash with what operators make.
CLASHING = sorted({*made_names(), "kept_id", "kept_digest", "place", "node", "id", "key", "row", "spans", "bucket", "label"})


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank, very long, repeated and tied rows."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "été", "日本", "x1", "Ünder", "the", "of"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    copy = prose(40)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "de", "b", 4),
        (4, copy, "en", "a", 1),
        (5, copy, "en", "b", 1),
        (6, copy.upper(), None, None, None),
        (7, prose(30_000), "fr", "c", 1),
        (7, prose(30), "fr", "c", 1),
        (8, "one", "en", "a", 3),
        (8, "one", "en", "a", 3),
        (None, prose(20), "en", "a", 1),
        (None, None, None, None, None),
        (9, "12345 !!! ---", "en", "b", 13),
        (10, "a\x00b c", "en", "b", 5),
    ]
    return rows + [(100 + i, prose(rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice(["a", "b", None]), 1) for i in range(40)]


def awkward(spark, clashing: bool = False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows(), DOCS).repartition(3)
    if clashing:
        df = df.withColumns({c: F.lit(f"kept {c}") for c in CLASHING})
    return df


def empty(spark, schema: str = DOCS):
    return spark.createDataFrame([], schema)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def text_words(text: str | None) -> list[str]:
    """The words of the contract by its pattern, character by character."""
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def blank_text_words(text: str | None) -> list[str]:
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def components(nodes, links) -> dict:
    """Smallest node reachable, by search."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo, out[n] = [n], n
        while todo:
            for m in near[todo.pop()]:
                if m not in out:
                    out[m] = n
                    todo.append(m)
    return out


