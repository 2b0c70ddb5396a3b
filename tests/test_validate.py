"""The rule table: one record per rule and edge."""

import copy
import json

import pytest

from voxledger.operators import validate as V

GOOD = {
    "id": "550e8400-e29b-41d4-a716-446655440000",
    "source": "ebi",
    "source_id": "11759",
    "status": "complete",
    "created_at": "2024-05-30T20:53:12Z",
    "metadata": {
        "core": {"description": "a volume", "volume_shape": [4, 8, 8], "voxel_size_nm": [4.0, 4.0, 4.0], "data_type": "uint8", "modality": "FIB-SEM"},
        "technical": {"file_size_bytes": 256, "sha256": "a" * 64, "compression": "none", "chunk_size": [4, 8, 8], "dimensions_nm": [1, 2.5]},
        "quality": {"completeness_score": 1.0, "validation_errors": ["x"], "metrics": {"deep": [1]}},
    },
    "files": {"volume": "v", "additional": {"k": 1}},
    "extra": {"anything": True},
}
DROP = object()

# (path, new value, expected (path, keyword) or None when still valid)
CASES = [
    ("extra", None, None),
    *[(k, DROP, ("", "required")) for k in ("id", "source", "source_id", "status", "created_at", "metadata")],
    ("metadata.core", DROP, ("metadata", "required")),
    ("metadata.core.description", DROP, ("metadata.core", "required")),
    ("id", None, ("id", "type")),
    ("id", 7, ("id", "type")),
    ("source_id", ["x"], ("source_id", "type")),
    ("updated_at", 5, ("updated_at", "type")),
    ("source", "empiar", ("source", "enum")),
    ("status", "done", ("status", "enum")),
    ("metadata.core.data_type", "int64", ("metadata.core.data_type", "enum")),
    ("metadata.core.modality", "X-ray", ("metadata.core.modality", "enum")),
    ("metadata.technical.compression", "zip", ("metadata.technical.compression", "enum")),
    ("metadata.core.description", "", ("metadata.core.description", "minLength")),
    ("metadata.technical.sha256", "a" * 63 + "g", ("metadata.technical.sha256", "pattern")),
    ("metadata.technical.sha256", "a" * 65, ("metadata.technical.sha256", "pattern")),
    ("progress", {"percentage": 100}, None),
    ("progress", {"percentage": -0.5}, ("progress.percentage", "minimum")),
    ("progress", {"percentage": 100.5}, ("progress.percentage", "maximum")),
    ("progress", {"percentage": True}, ("progress.percentage", "type")),
    ("progress", {"percentage": "50"}, ("progress.percentage", "type")),
    ("progress", [], ("progress", "type")),
    ("error", {"retry_count": 2.0}, None),
    ("error", {"retry_count": 2.5}, ("error.retry_count", "type")),
    ("error", {"retry_count": -1}, ("error.retry_count", "minimum")),
    ("metadata", "flat", ("metadata", "type")),
    ("metadata", None, ("metadata", "type")),
    ("metadata.core.volume_shape", [4], ("metadata.core.volume_shape", "minItems")),
    ("metadata.core.volume_shape", [1, 1, 1, 1, 1], ("metadata.core.volume_shape", "maxItems")),
    ("metadata.core.volume_shape", [4, 0], ("metadata.core.volume_shape[1]", "minimum")),
    ("metadata.core.volume_shape", [2.0, 3], None),
    ("metadata.core.volume_shape", [2.5, 3], ("metadata.core.volume_shape[0]", "type")),
    ("metadata.core.volume_shape", [True, 3], ("metadata.core.volume_shape[0]", "type")),
    ("metadata.core.volume_shape", {"z": 1}, ("metadata.core.volume_shape", "type")),
    ("metadata.core.voxel_size_nm", {"x": 4.0, "y": 4.0, "z": 2.96}, None),
    ("metadata.core.voxel_size_nm", {}, None),
    ("metadata.core.voxel_size_nm", {"x": "4"}, ("metadata.core.voxel_size_nm", "oneOf")),
    ("metadata.core.voxel_size_nm", [4.0], ("metadata.core.voxel_size_nm", "oneOf")),
    ("metadata.core.voxel_size_nm", [4.0, -1], ("metadata.core.voxel_size_nm", "oneOf")),
    ("metadata.core.voxel_size_nm", "4x4", ("metadata.core.voxel_size_nm", "oneOf")),
    ("metadata.technical.file_size_bytes", -1, ("metadata.technical.file_size_bytes", "minimum")),
    ("metadata.technical.chunk_size", [], None),
    ("metadata.technical.chunk_size", [0], ("metadata.technical.chunk_size[0]", "minimum")),
    ("metadata.technical.dimensions_nm", [1, -2], ("metadata.technical.dimensions_nm[1]", "minimum")),
    ("metadata.quality.completeness_score", 1.01, ("metadata.quality.completeness_score", "maximum")),
    ("metadata.quality.validation_errors", ["a", 1], ("metadata.quality.validation_errors[1]", "type")),
    ("metadata.quality.metrics", [], ("metadata.quality.metrics", "type")),
    ("files", {"additional": "x"}, ("files.additional", "type")),
    ("additional_metadata", [1], ("additional_metadata", "type")),
]


def changed(path, value):
    record = copy.deepcopy(GOOD)
    *parents, last = path.split(".")
    node = record
    for p in parents:
        node = node[p]
    if value is DROP:
        del node[last]
    else:
        node[last] = value
    return record


def files(spark, texts, folder="/data/ebi"):
    rows = [(f"{folder}/metadata_{i}.json", folder, f"metadata_{i}.json", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file string, dir string, fname string, value string").selectExpr(
        "file", "dir", "fname", "timestamp'2024-01-01' AS mtime", "value"
    )


@pytest.fixture(scope="module")
def judged(spark):
    texts = [json.dumps(changed(p, v)) for p, v, _ in CASES]
    checked = V.validate(files(spark, texts)).collect()
    return {int(r["fname"][9:-5]): r for r in checked}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{p}={'absent' if v is DROP else v}" for p, v, _ in CASES])
def test_rule(judged, i):
    expected, row = CASES[i][2], judged[i]
    assert [(x["path"], x["keyword"]) for x in row["violations"]] == ([expected] if expected else [])
    assert row["valid"] == (expected is None)
    assert len(row["errors"]) == (0 if expected is None else 1)


def test_messages_and_best_error(spark):
    bad = changed("status", "done")
    bad["metadata"]["core"]["volume_shape"] = [0]
    del bad["created_at"]
    row = V.validate(files(spark, [json.dumps(bad)])).first()
    assert {x["message"] for x in row["violations"]} == {
        "'created_at' is a required property",
        "'done' is not one of ['pending', 'processing', 'saving-data', 'complete', 'failed', 'cancelled']",
        "[0] is too short",
        "0 is less than the minimum of 1",
    }
    assert row["errors"] == ["'created_at' is a required property"]


def test_loads_that_are_not_records(spark):
    texts = ["{bad", "", "[1]", '"s"', "null", "true", "1", "1.5", '{"source": ["ebi"]}', '{"source": {"a": 1}}', "{}"]
    rows = {int(r["fname"][9:-5]): r for r in V.validate(files(spark, texts)).collect()}
    assert [rows[i]["error_class"] for i in range(11)] == ["parse"] * 2 + ["processing"] * 8 + ["schema"]
    assert rows[2]["errors"] == ["Processing error: 'list' object has no attribute 'get'"]
    assert rows[4]["errors"] == ["Processing error: 'NoneType' object has no attribute 'get'"]
    assert rows[6]["errors"] == ["Processing error: 'int' object has no attribute 'get'"]
    assert rows[9]["errors"] == ["Processing error: unhashable type: 'dict'"]
    assert not rows[0]["parsed"] and rows[2]["parsed"]
    assert len(rows[10]["violations"]) == 6


def test_repeated_key_takes_last_value(spark):
    text = json.dumps(GOOD)[:-1] + ', "status": "failed"}'
    row = V.validate(files(spark, [text])).selectExpr("valid", "variant_get(v, '$.status', 'string') AS status").first()
    assert row["valid"] and row["status"] == "failed"


@pytest.mark.parametrize("value", ['""', "null", "0", "false", "[]", "{}"])
def test_empty_source_falls_back_to_folder(spark, value):
    text = '{"source": %s}' % value
    assert V.parse_records(files(spark, [text], "/data/idr/x"), ["/other", "/data"]).first()["source"] == "idr"
    assert V.parse_records(files(spark, [text], "/data/else"), ["/data"]).first()["source"] == "unknown"
    assert V.parse_records(files(spark, [text], "/data/idr"), ["/data/idr"]).first()["source"] == "unknown"


def test_formats_only_when_strict(spark):
    odd = [changed("id", "not-a-uuid"), changed("created_at", "yesterday"), changed("created_at", "2024-13-01T00:00:00Z")]
    good = changed("updated_at", "2024-05-30T20:53:12.252681+00:00")
    texts = [json.dumps(r) for r in [*odd, good]]
    assert all(r["valid"] for r in V.validate(files(spark, texts)).collect())
    strict = {r["fname"]: r for r in V.validate(files(spark, texts), strict_formats=True).collect()}
    assert [strict[f"metadata_{i}.json"]["valid"] for i in range(4)] == [False, False, False, True]


def test_strict_gate(spark):
    good = V.validate(files(spark, [json.dumps(GOOD)]))
    bad = V.validate(files(spark, [json.dumps(GOOD), "{bad"]))
    assert V.strict_gate(good) == 0
    assert V.strict_gate(bad, strict=False) == 1
    assert V.strict_gate(bad, fail_on_invalid=False) == 1
    with pytest.raises(V.InvalidRecords):
        V.strict_gate(bad)


ALTERNATIVES = [
    ({"x": -1, "y": 4}, "-1 is less than the minimum of 0"),
    ({"x": 1, "z": "4"}, "'4' is not of type 'number'"),
    ({"y": -2, "x": "a"}, "'a' is not of type 'number'"),
    ([4, -3, "b"], "-3 is less than the minimum of 0"),
    ([4, "b", -3], "'b' is not of type 'number'"),
    ([4.5], "[4.5] is too short"),
    ([1, 2, 3, 4, 5], "[1,2,3,4,5] is too long"),
    ("4x4", "'4x4' is not valid under any of the given schemas"),
]


def test_a_failed_alternative_reports_the_best_error_inside(spark):
    texts = [json.dumps(changed("metadata.core.voxel_size_nm", voxel)) for voxel, _ in ALTERNATIVES]
    rows = {int(r["fname"][9:-5]): r["errors"] for r in V.validate(files(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == [[message] for _, message in ALTERNATIVES]
