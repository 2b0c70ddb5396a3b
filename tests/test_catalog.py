"""Catalogue document against the published run, sinks and real file scans."""

import json

import pytest

from tests.test_validate import GOOD, changed, files
from voxledger.operators import catalog as C
from voxledger.operators import ingest as I
from voxledger.operators import migrate as M
from voxledger.operators import sinks as K
from voxledger.operators.validate import InvalidRecords, validate
from voxledger.sources import files as S

COUNTS = {"ebi": 16, "epfl": 1, "flyem": 1, "idr": 1, "openorganelle": 9}
BASE = ["created_at", "files", "id", "metadata", "source", "source_id", "status", "updated_at"]
EXTRA = {"ebi": ["additional_metadata"], "flyem": ["additional_metadata"], "openorganelle": ["local_paths"]}


def record(source):
    out = {k: v for k, v in GOOD.items() if k != "extra"} | {"source": source, "updated_at": "2024-05-30T20:53:13Z"}
    return out | {k: {"k": 1} for k in EXTRA.get(source, [])}


@pytest.fixture(scope="module")
def published(spark):
    return validate(files(spark, [json.dumps(record(s)) for s, n in COUNTS.items() for _ in range(n)]))


def read_document(spark, path):
    return json.loads("".join(r["value"] for r in spark.read.text(path).collect()))


def test_catalog_of_the_published_run(spark, published, tmp_path):
    K.write_catalog(published, str(tmp_path / "catalog"), "2025-06-11T22:16:33", ["/data"])
    doc = read_document(spark, str(tmp_path / "catalog"))
    assert list(doc) == sorted(doc)
    legacy = doc["legacy_compatibility"]
    assert legacy["distinct_keys"] == sorted([*BASE, "additional_metadata", "local_paths"])
    assert legacy["total_files_by_source"] == COUNTS
    assert legacy["key_ratios_by_source"] == {
        key: {s: 1.0 for s in COUNTS if key in BASE + EXTRA.get(s, [])} for key in legacy["distinct_keys"]
    }
    assert doc["data_quality"]["completeness_by_source"] == {
        s: {"average_fields": 8.0 + len(EXTRA.get(s, [])), "required_fields_present": 100.0} for s in COUNTS
    }
    assert doc["data_quality"]["schema_compliance_rate"] == 100.0
    assert doc["data_quality"]["common_missing_fields"] == {}
    assert doc["summary"] == {
        "parsing_errors": 0, "processed_files": 28, "sources_found": sorted(COUNTS), "total_files": 28, "validation_errors": 0,
    }
    assert doc["validation"]["errors_by_source"] == {s: {"errors": 0, "invalid": 0, "valid": n} for s, n in COUNTS.items()}
    assert (doc["validation"]["valid_files"], doc["validation"]["validation_rate"]) == (28, 100.0)
    assert len(doc["valid_records_sample"]) == 5 and doc["valid_records_sample"][0]["source"] == "ebi"
    assert doc["metadata"]["configuration"]["include_patterns"] == ["*metadata*.json"]


def test_counters_with_broken_files(spark):
    texts = [json.dumps(GOOD), json.dumps(changed("status", "done")), "[1]", "{bad"]
    row = C.run_counters(validate(files(spark, texts))).first()
    assert (row["total_files"], row["processed_files"], row["validation_errors"], row["parsing_errors"]) == (4, 3, 1, 2)
    assert row["validation_rate"] == 25.0
    empty = C.run_counters(validate(files(spark, ["{}"])).where("false")).first()
    assert (empty["total_files"], empty["validation_rate"]) == (0, 0.0)
    assert C.valid_share(C.latest_validity(validate(files(spark, ["{}"])).where("false"))).first()["percent"] == 0.0


def test_completeness_with_other_required_fields(spark):
    flat = validate(files(spark, [json.dumps(GOOD)]))
    assert C.completeness(flat).first()["required_fields_present"] == 100.0
    assert C.completeness(flat, ["source", "description"]).first()["required_fields_present"] == 0.0
    assert [r["field"] for r in C.missing_fields(flat, ["source", "description"]).collect()] == ["description"]


def test_validated_write_and_report(spark, tmp_path):
    results = validate(files(spark, [json.dumps(GOOD), json.dumps(changed("status", "done")), "{bad"]))
    written, detail, summary = (str(tmp_path / n) for n in ("written", "detail", "summary"))
    K.write_validated(results, written)
    good = spark.read.parquet(written).where("outcome = 'valid'").collect()
    assert [json.loads(r["record"]) for r in good] == [GOOD] and good[0]["errors"] == []
    assert sorted(r["error_class"] for r in spark.read.parquet(f"{written}/outcome=quarantine").collect()) == ["parse", "schema"]
    K.write_report(results, detail, summary)
    assert spark.read.json(detail).count() == 3
    doc = read_document(spark, summary)["summary"]
    assert (doc["valid_files"], doc["invalid_files"], doc["total_files"]) == (1, 2, 3)
    assert doc["errors_by_source"]["unknown"] == {"errors": 1, "invalid": 1, "valid": 0}


def test_cleanup_writes_a_new_version(spark, tmp_path):
    results = validate(files(spark, [json.dumps(GOOD), json.dumps(changed("id", None)), '{"source": "ebi"}']))
    marked = M.cleanup(results)
    assert {r["fname"]: r["outcome"] for r in marked.collect()} == {
        "metadata_0.json": "keep_valid", "metadata_1.json": "keep_invalid", "metadata_2.json": "remove",
    }
    K.write_new_version(spark, marked.select("file", "source"), marked.where("outcome = 'remove'"), str(tmp_path / "v2"))
    assert spark.read.parquet(str(tmp_path / "v2")).count() == 2


def test_migration_times_and_defaults(spark):
    old = [
        {"source": "ebi", "timestamp": "2024-02-03T04:05:06Z", "dimensions_nm": [1.0, 2.0]},
        {"source": "ebi", "timestamp": "2024-02-03T04:05:06+02:00"},
        {"source": "ebi", "timestamp": "2024-02-03T04:05:06"},
        {"source": "ebi", "timestamp": "soon"},
        {},
    ]
    moved = M.migrate_checked(validate(files(spark, [json.dumps(o) for o in old])).drop("violations", "best", "valid", "errors", "error_class"))
    rows = {int(r["fname"][9:-5]): r for r in moved.select("fname", "outcome", "record").collect()}
    assert [rows[i]["record"]["created_at"] for i in range(5)] == [
        "2024-02-03T04:05:06Z", "2024-02-03T04:05:06+02:00", "2024-02-03T04:05:06", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z",
    ]
    assert [rows[i]["outcome"] for i in range(5)] == ["converted"] * 4 + ["failed"]
    assert rows[0]["record"]["metadata"]["technical"]["dimensions_nm"] == [1.0, 2.0]
    assert rows[4]["record"]["metadata"]["core"]["description"] == "Data from unknown"
    assert rows[0]["record"]["status"] == "complete"


def test_scan_of_real_folders(spark, tmp_path):
    layout = {
        "ebi/metadata_1.json": json.dumps(GOOD), "ebi/a b+c_metadata.json": "{bad", "ebi/deep/x_metadata_2.json": "{}",
        "ebi/metadata_3.json.tmp": "{}", "ebi/notes.json": "{}", "consolidate/metadata_4.json": "{}",
        "consolidate/idr/metadata_5.json": "{}",
    }
    for name, text in layout.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    root = str(tmp_path)
    found = S.scan(S.read_record_files(spark, [root, str(tmp_path / "absent")]))
    assert sorted(r["file"] for r in found.collect()) == sorted(
        f"{root}/{n}" for n in ("ebi/metadata_1.json", "ebi/a b+c_metadata.json", "ebi/deep/x_metadata_2.json", "consolidate/idr/metadata_5.json")
    )
    twice = S.read_record_files(spark, [root, f"{root}/ebi"])
    assert twice.where("fname = 'metadata_1.json'").count() == 2
    assert S.scan_union([twice, twice], distinct=True).count() == len(layout)
    flat = S.read_record_files(spark, [f"{root}/ebi"], recursive=False, name_glob="*metadata*.json")
    assert flat.count() == 2
    assert S.read_record_files(spark, [f"{root}/absent"]).count() == 0
    sources = {r["fname"]: r["source"] for r in validate(found, [root]).collect()}
    assert sources == {"metadata_1.json": "ebi", "a b+c_metadata.json": "unknown", "x_metadata_2.json": "ebi", "metadata_5.json": "unknown"}


def test_consolidate_job(spark, tmp_path):
    for name, text in {"ebi/metadata_1.json": json.dumps(GOOD), "idr/metadata_2.json": "{}"}.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    counters = I.consolidate(spark, [root], out, "now", exclude=["*.tmp"], strict=True, document=True)
    assert (counters["total_files"], counters["valid_files"], counters["invalid_files"]) == (2, 1, 1)
    assert {r["source"] for r in spark.read.parquet(f"{out}/catalog/sources").collect()} == {"ebi", "idr"}
    doc = read_document(spark, f"{out}/catalog_document")
    assert doc["metadata"]["configuration"] == {
        "exclude_patterns": ["*.tmp"], "include_patterns": ["*metadata*.json"], "scan_directories": [root], "validation_enabled": True,
    }
    assert doc["legacy_compatibility"]["total_files_by_source"] == {"ebi": 1, "idr": 1}
    assert spark.read.json(f"{out}/report").count() == 2
    with pytest.raises(InvalidRecords):
        I.consolidate(spark, [root], out, "now", strict=True, fail_on_invalid=True)
    assert {r["key"] for r in I.key_presence(spark, root).collect()} == set(GOOD)


def test_catalog_tables_hold_what_the_document_holds(spark, published, tmp_path):
    K.write_catalog_tables(published, str(tmp_path / "tables"))
    sources = {r["source"]: json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / "tables/sources")).collect()}
    assert {s: d["total"] for s, d in sources.items()} == COUNTS
    assert all(d["invalid"] == 0 and set(d["missing"].values()) == {0} for d in sources.values())
    ratios = spark.read.parquet(str(tmp_path / "tables/key_ratios")).where("ratio = 1").count()
    assert ratios == sum(len(BASE) + len(EXTRA.get(s, [])) for s in COUNTS)
    assert spark.read.parquet(str(tmp_path / "tables/sample")).count() == 5
