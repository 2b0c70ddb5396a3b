"""Shell-style name patterns as anchored regular expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_REGEX_SPECIAL = set("\\.^$+{}()|[]*?")


def glob_to_regex(pattern: str) -> str:
    """``*``, ``?``, ``[seq]`` and ``[!seq]``; case matters; no brace lists."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[" and (end := pattern.find("]", i + 1 + (pattern[i : i + 1] == "!"))) != -1:
            body = pattern[i:end].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&")
            negate = body.startswith("!")
            body = body[1:] if negate else body
            if body.startswith("^"):
                body = "\\" + body
            out.append("[" + ("^" if negate else "") + body + "]")
            i = end + 1
        else:
            out.append("\\" + ch if ch in _REGEX_SPECIAL else ch)
    return "(?s)^" + "".join(out) + "$"


def any_glob(column: Column, patterns: list[str]) -> Column:
    """True where the name matches at least one pattern."""
    return reduce(lambda a, b: a | b, (column.rlike(glob_to_regex(p)) for p in patterns), F.lit(False))


def glob_semi(df: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Rows whose name matches any pattern."""
    return df.where(any_glob(F.col(column), patterns))


def glob_anti(df: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Rows whose name matches no pattern."""
    return df.where(~any_glob(F.col(column), patterns))
