"""Record parsing and contract rules as column expressions.

Every rule of ``contract.RECORD`` becomes one expression over the parsed
VARIANT, so a record is checked in the task that read it: no join, no shuffle,
no Python.  Within a record the reported error is the shallowest one, then the
first in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.contract import Field
from voxledger.functions import variants as V
from voxledger.functions.stages import computed_once

VIOLATION = "struct<depth:int,weak:int,pos:int,item:int,path:string,keyword:string,message:string,inner:string>"


# ---- parsing ---------------------------------------------------------------
def parse_records(files: DataFrame, roots: list[str] | None = None) -> DataFrame:
    """Parse ``value`` and attribute each file to a source.

    Adds ``v`` (VARIANT), ``keys``, ``source``, ``parsed`` and ``load_error``.
    ``load_error`` holds the text for files that are not JSON, are not an
    object, or whose source cannot be used as a key.
    """
    df = computed_once(files, "v", F.try_parse_json("value"))
    df = df.withColumns(
        {
            "parsed": F.col("v").isNotNull(),
            "_object": V.is_object(F.col("v")),
            "_source": V.leaf(F.col("v"), "source"),
        }
    ).withColumn("_source_type", F.schema_of_variant("_source"))
    source_text = V.as_text(F.col("_source"))
    collection = F.col("_source_type").startswith("ARRAY") | F.col("_source_type").startswith("OBJECT")
    falsy = (
        F.col("_source").isNull()
        | F.col("_source_type").isin("VOID", "OBJECT<>")
        | ((F.col("_source_type") == "STRING") & (source_text == ""))
        | ((F.col("_source_type") == "BOOLEAN") & (source_text == "false"))
        | (V.is_number(F.col("_source_type")) & (F.try_variant_get("_source", "$", "double") == 0))
        | (F.col("_source_type").startswith("ARRAY") & (F.size(V.elements(F.col("_source"))) == 0))
    )
    unusable = ~falsy & collection
    found = F.coalesce(F.when(~falsy, source_text), *_source_from_dir(roots or []), F.lit("unknown"))
    load_error = (
        F.when(~F.col("parsed"), F.lit("JSON parsing error"))
        .when(
            ~F.col("_object"),
            F.format_string("Processing error: '%s' object has no attribute 'get'", _type_word(F.schema_of_variant("v"))),
        )
        .when(
            unusable,
            F.format_string("Processing error: unhashable type: '%s'", _type_word(F.col("_source_type"))),
        )
    )
    return (
        df.withColumn("load_error", load_error)
        .withColumns(
            {
                "source": F.when(F.col("load_error").isNotNull(), "unknown").otherwise(found),
                "keys": F.when(F.col("load_error").isNull(), V.object_keys(F.col("v"))),
            }
        )
        .drop("_object", "_source", "_source_type", "value")
    )


def _source_from_dir(roots: list[str]) -> list[Column]:
    """First path part below a scan root, when it names a known source."""
    out = []
    for root in roots:
        prefix = root.rstrip("/") + "/"
        first = F.element_at(F.split(F.substring(F.col("file"), len(prefix) + 1, 1 << 30), "/"), 1)
        deeper = F.substring(F.col("file"), len(prefix) + 1, 1 << 30).contains("/")
        out.append(F.when(F.col("file").startswith(prefix) & deeper & first.isin(contract.SOURCES), first))
    return out


def _type_word(type_name: Column) -> Column:
    """The name a JSON loader gives a value's type in its messages."""
    return (
        F.when(type_name.startswith("ARRAY"), "list")
        .when(type_name.startswith("OBJECT"), "dict")
        .when(type_name == "STRING", "str")
        .when(type_name == "BIGINT", "int")
        .when(type_name == "BOOLEAN", "bool")
        .when(type_name == "VOID", "NoneType")
        .otherwise("float")
    )


# ---- rules -----------------------------------------------------------------
# Rules are written as SQL text: the whole set is a few hundred expressions, and
# one parse is far cheaper than building each through the Column API.
def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def _number(value: str) -> str:
    return f"try_variant_get({value}, '$', 'double')"


def _shown(value: str, kind: str) -> str:
    """A value as it appears in messages: text quoted, the rest as JSON."""
    return f"CASE WHEN {kind} = 'STRING' THEN concat('\\'', {_text(value)}, '\\'') ELSE to_json({value}) END"


def _is_number(kind: str) -> str:
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def _has_kind(expected: str, value: str, kind: str) -> str:
    ok = {
        "object": f"try_variant_get({value}, '$', 'struct<_:variant>') IS NOT NULL",
        "array": f"startswith({kind}, 'ARRAY')",
        "string": f"{kind} = 'STRING'",
        "number": _is_number(kind),
        "integer": f"{_is_number(kind)} AND {_number(value)} = floor({_number(value)})",
    }[expected]
    return f"coalesce({ok}, false)"


def _value_rules(field: Field, value: str, kind: str, strict_formats: bool = False) -> list[tuple[str, str, str]]:
    """(keyword, failed, message end) of the value rules, in contract order."""
    out = []
    if field.enum:
        allowed = ", ".join(f"'{x}'" for x in field.enum)
        listed = ", ".join(_quote(x) for x in field.enum)
        out.append(("enum", f"{_text(value)} NOT IN ({listed})", f" is not one of [{allowed}]"))
    if field.min_length is not None:
        out.append(("minLength", f"length({_text(value)}) < {field.min_length}", " is too short"))
    if field.pattern:
        out.append(("pattern", f"NOT rlike({_text(value)}, {_quote(field.pattern)})", f" does not match '{field.pattern}'"))
    if field.low is not None:
        out.append(("minimum", f"{_number(value)} < {field.low}", f" is less than the minimum of {field.low}"))
    if field.high is not None:
        out.append(("maximum", f"{_number(value)} > {field.high}", f" is greater than the maximum of {field.high}"))
    if strict_formats and field.format:
        bad = f"NOT rlike({_text(value)}, {_quote(contract.FORMAT_PATTERNS[field.format])})"
        if field.format in ("date-time", "date"):
            bad += f" OR try_to_timestamp(upper({_text(value)})) IS NULL"
        out.append(("format", f"({bad})", f" is not a '{field.format}'"))
    return out


def _fits(field: Field, value: str, kind: str) -> str:
    """True where a value satisfies one branch of an alternative."""
    if field.kind == "array":
        items = f"try_variant_get({value}, '$', 'array<variant>')"
        return (
            f"startswith({kind}, 'ARRAY') AND size({items}) BETWEEN {field.min_items} AND {field.max_items}"
            f" AND forall({items}, x -> {_scalar_fits(field.items, 'x')})"
        )
    parts = [_has_kind("object", value, kind)]
    for child in field.children:
        inner = f"try_variant_get({value}, '$.{child.name}', 'variant')"
        parts.append(f"({inner} IS NULL OR {_scalar_fits(child, inner)})")
    return " AND ".join(parts)


def _scalar_fits(field: Field, value: str) -> str:
    kind = f"schema_of_variant({value})"
    rules = [f"NOT ({failed})" for _, failed, _ in _value_rules(field, value, kind)]
    return f"coalesce({' AND '.join([_has_kind(field.kind, value, kind), *rules])}, false)"


def _inner_error(branches: tuple[Field, ...], value: str, kind: str) -> str:
    """The best error inside the branches of a failed alternative; NULL if none is better than the rest.

    Relevance inside a failed alternative is turned round: the deepest error tells which branch was
    meant, of equally deep ones the first by path; then an error of the branch whose type the value has.
    A value that fits the type of no branch has no better error than the alternative's own.
    """
    deep, shallow = [], []
    for branch in branches:
        right = _has_kind(branch.kind, value, kind)
        if branch.kind == "array":
            items = f"try_variant_get({value}, '$', 'array<variant>')"
            found = f"try_element_at(array_compact(transform({items}, x -> {_scalar_error(branch.items, 'x')})), 1)"
            deep.append(f"CASE WHEN {right} THEN {found} END")
            for bound, text in (
                (f"size({items}) < {branch.min_items}", " is too short"),
                (f"size({items}) > {branch.max_items}", " is too long"),
            ):
                shallow.append(f"CASE WHEN {right} AND {bound} THEN concat({_shown(value, kind)}, {_quote(text)}) END")
        else:
            for child in sorted(branch.children, key=lambda c: c.name):
                inner = f"try_variant_get({value}, '$.{child.name}', 'variant')"
                deep.append(f"CASE WHEN {right} AND {inner} IS NOT NULL THEN {_scalar_error(child, inner)} END")
    return f"coalesce({', '.join([*deep, *shallow])})"


def _scalar_error(field: Field, value: str) -> str:
    """The first error message of a scalar; NULL if it fits."""
    kind = f"schema_of_variant({value})"
    cases = [(f"NOT {_has_kind(field.kind, value, kind)}", f" is not of type '{field.kind}'")]
    cases += [(failed, text) for _, failed, text in _value_rules(field, value, kind)]
    whens = " ".join(f"WHEN {failed} THEN concat({_shown(value, kind)}, {_quote(text)})" for failed, text in cases)
    return f"CASE {whens} END"


def _violation(
    depth: int, weak: int, pos: int, path: str, keyword: str, message: str, item: str = "-1", inner: str = "CAST(NULL AS STRING)"
) -> str:
    return (
        f"named_struct('depth', {depth}, 'weak', {weak}, 'pos', {pos}, 'item', {item}, 'path', {path},"
        f" 'keyword', {_quote(keyword)}, 'message', {message}, 'inner', {inner})"
    )


class _Rules:
    """Leaf columns and rule expressions, collected by walking the contract."""

    def __init__(self, strict_formats: bool):
        self.strict_formats = strict_formats
        self.leaves: list[str] = []
        self.types: list[str] = []
        self.single: list[str] = []
        self.repeated: list[str] = []
        self.names: list[str] = []
        self.pos = 0

    def hit(
        self, failed: str, depth: int, path: str, keyword: str, message: str, weak: int = 0, inner: str = "CAST(NULL AS STRING)"
    ) -> None:
        self.pos += 1
        row = _violation(depth, weak, self.pos, _quote(path), keyword, message, inner=inner)
        self.single.append(f"CASE WHEN {failed} THEN {row} END")

    def walk(self, field: Field, path: str, depth: int) -> None:
        value = f"_n{len(self.leaves)}"
        kind = f"{value}t"
        self.names += [value, kind]
        self.leaves.append(f"try_variant_get(v, '{V.step(path)}', 'variant') AS {value}")
        self.types.append(f"schema_of_variant({value}) AS {kind}")
        ending = lambda text: f"concat({_shown(value, kind)}, {_quote(text)})"
        if field.one_of:
            matches = " + ".join(f"CAST(coalesce({_fits(b, value, kind)}, false) AS INT)" for b in field.one_of)
            self.hit(
                f"{value} IS NOT NULL AND ({matches}) <> 1", depth, path, "oneOf",
                ending(" is not valid under any of the given schemas"), weak=1, inner=_inner_error(field.one_of, value, kind),
            )
            return
        right = _has_kind(field.kind, value, kind)
        self.hit(f"{value} IS NOT NULL AND NOT {right}", depth, path, "type", ending(f" is not of type '{field.kind}'"))
        if field.kind == "object":
            inside = lambda child: f"{path}.{child.name}".lstrip(".")
            for child in field.children:
                if child.required:
                    absent = f"try_variant_get(v, '{V.step(inside(child))}', 'variant') IS NULL"
                    self.hit(
                        f"{right} AND {absent}", depth, path, "required", _quote(f"'{child.name}' is a required property")
                    )
            for child in field.children:
                self.walk(child, inside(child), depth + 1)
            return
        for keyword, failed, text in _value_rules(field, value, kind, self.strict_formats):
            self.hit(f"{right} AND {failed}", depth, path, keyword, ending(text))
        if field.kind == "array":
            items = f"try_variant_get({value}, '$', 'array<variant>')"
            self.items(field.items, items, right, path, depth + 1)
            for keyword, failed, text in (
                ("minItems", field.min_items and f"size({items}) < {field.min_items}", " is too short"),
                ("maxItems", field.max_items and f"size({items}) > {field.max_items}", " is too long"),
            ):
                if failed:
                    self.hit(f"{right} AND {failed}", depth, path, keyword, ending(text))

    def items(self, item: Field, items: str, right: str, path: str, depth: int) -> None:
        """One violation per failing rule of each array element."""
        kind = "schema_of_variant(x)"
        good = _has_kind(item.kind, "x", kind)
        where = f"concat({_quote(path + '[')}, i, ']')"
        checks = [("type", f"NOT {good}", f" is not of type '{item.kind}'")]
        checks += [(k, f"{good} AND {failed}", text) for k, failed, text in _value_rules(item, "x", kind)]
        rows = []
        for keyword, failed, text in checks:
            self.pos += 1
            message = f"concat({_shown('x', kind)}, {_quote(text)})"
            rows.append(f"CASE WHEN {failed} THEN {_violation(depth, 0, self.pos, where, keyword, message, 'i')} END")
        per_item = f"flatten(transform({items}, (x, i) -> array_compact(array({', '.join(rows)}))))"
        self.repeated.append(f"CASE WHEN {right} THEN {per_item} ELSE array() END")


def add_violations(records: DataFrame, strict_formats: bool = False) -> DataFrame:
    """Add ``violations``: every broken rule of each loaded record."""
    rules = _Rules(strict_formats)
    rules.walk(contract.RECORD, "", 0)
    parts = [f"array_compact(array({', '.join(rules.single)}))", *rules.repeated]
    every = ", ".join(f"CAST({part} AS array<{VIOLATION}>)" for part in parts)
    found = f"CASE WHEN load_error IS NULL THEN concat({every}) ELSE CAST(array() AS array<{VIOLATION}>) END"
    typed = records.selectExpr("*", *rules.leaves).selectExpr("*", *rules.types)
    return computed_once(typed, "violations", F.expr(found)).drop(*rules.names)


def add_verdict(checked: DataFrame) -> DataFrame:
    """Add ``valid``, ``error_class``, ``best`` and the one-error ``errors`` list.

    A failed alternative is reported by the best error inside its branches, if there is one.
    """
    best = F.array_min("violations")
    return (
        checked.withColumn("best", best)
        .withColumns(
            {
                "error_class": F.when(~F.col("parsed"), "parse")
                .when(F.col("load_error").isNotNull(), "processing")
                .when(F.col("best").isNotNull(), "schema"),
            }
        )
        .withColumns(
            {
                "valid": F.col("error_class").isNull(),
                "errors": F.when(F.col("load_error").isNotNull(), F.array("load_error"))
                .when(F.col("best").isNotNull(), F.array(F.coalesce("best.inner", "best.message")))
                .otherwise(F.array().cast("array<string>")),
            }
        )
    )


def validate(files: DataFrame, roots: list[str] | None = None, strict_formats: bool = False) -> DataFrame:
    """Parse, check and judge record files in one pass over them."""
    return add_verdict(add_violations(parse_records(files, roots), strict_formats))


def violation_rows(checked: DataFrame, *keep: str) -> DataFrame:
    """One row per broken rule.

    The outer form keeps the planner from copying the whole rule expression
    into an extra filter below the generator.
    """
    rows = checked.select(*keep, F.explode_outer("violations").alias("x"))
    return rows.where(F.col("x").isNotNull()).select(*keep, "x.*")


class InvalidRecords(RuntimeError):
    """Raised by the strict gate."""


def strict_gate(results: DataFrame, strict: bool = True, fail_on_invalid: bool = True) -> int:
    """Count invalid files; raise when strict mode is set to fail on them."""
    invalid = results.where(~F.col("valid")).count()
    if strict and fail_on_invalid and invalid:
        raise InvalidRecords(f"{invalid} validation failures")
    return invalid
