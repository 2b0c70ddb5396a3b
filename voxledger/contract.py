"""The record contract: fixed values every result depends on.

The lists, bounds, patterns and property order below are the published record
format.  They are stated once, in their natural order; ``operators.validate``
turns them into column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values ---------------------------------------------------------
SOURCES = ["ebi", "epfl", "flyem", "idr", "openorganelle"]
STATUSES = ["pending", "processing", "saving-data", "complete", "failed", "cancelled"]
DATA_TYPES = ["uint8", "uint16", "uint32", "int8", "int16", "int32", "float32", "float64"]
MODALITIES = ["EM", "FIB-SEM", "SEM", "TEM", "STEM", "cryo-EM"]
COMPRESSIONS = ["none", "gzip", "lz4", "blosc", "zarr"]
SHA256_PATTERN = "^[a-f0-9]{64}$"
REQUIRED_TOP = ["id", "source", "source_id", "status", "created_at", "metadata"]
LEGACY_SOURCE = "empiar"
INCLUDE_PATTERNS = ["*metadata*.json"]
EXCLUDE_PATTERNS = ["*.tmp", "*.log", "*.backup"]
OUTPUT_DIR_NAME = "consolidate"
SUPPORTED_SUFFIXES = {".mrc": "mrc", ".dm3": "dm3", ".ser": "ser"}
ITEM_SIZES = {
    "uint8": 1, "int8": 1, "uint16": 2, "int16": 2,
    "uint32": 4, "int32": 4, "float32": 4, "float64": 8,
}
DEFAULT_ITEM_SIZE = 4
SLICE_TITLE = "EBI EMPIAR dataset "
IMAGE_TITLE = "IDR image "
SECTION_TITLE = "5x5x5µm section from CA1 hippocampus region"
CROP_TITLE = "Random crop at (%s) from FlyEM DVID"
ARRAY_TITLE = "Array '%s' from OpenOrganelle Zarr S3 store"
IMAGING_START = "2015-03-09"
ARCHIVE_ROOT = "/empiar/world_availability/"
# What a service log says when its configuration could not be imported.
LOG_IMPORT_ERROR = "ModuleNotFoundError.*config_manager"
RUN_FIELDS = {
    "commit_sha": "CI_COMMIT_SHA",
    "commit_ref": "CI_COMMIT_REF",
    "pipeline_id": "CI_PIPELINE_ID",
    "pipeline_url": "CI_PIPELINE_URL",
    "triggered_by": "CI_TRIGGERED_BY",
    "workflow_name": "CI_WORKFLOW_NAME",
    "runner_os": "RUNNER_OS",
    "github_repository": "GITHUB_REPOSITORY",
    "github_event_name": "GITHUB_EVENT_NAME",
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One property of the record and the rules on it."""

    name: str
    kind: str | None = None
    required: bool = False
    enum: tuple[str, ...] = ()
    min_length: int | None = None
    pattern: str | None = None
    low: float | None = None
    high: float | None = None
    min_items: int | None = None
    max_items: int | None = None
    items: "Field | None" = None
    one_of: tuple["Field", ...] = ()
    children: tuple["Field", ...] = ()
    format: str | None = None


def text(name: str, **kw) -> Field:
    return Field(name, "string", **kw)


def number(name: str, **kw) -> Field:
    return Field(name, "number", **kw)


def integer(name: str, **kw) -> Field:
    return Field(name, "integer", **kw)


def listing(name: str, items: Field, **kw) -> Field:
    return Field(name, "array", items=items, **kw)


def group(name: str, *children: Field, **kw) -> Field:
    return Field(name, "object", children=children, **kw)


# ---- fixed values: the properties in document order ------------------------
RECORD = group(
    "",
    text("id", required=True, format="uuid"),
    text("source", required=True, enum=tuple(SOURCES)),
    text("source_id", required=True),
    text("status", required=True, enum=tuple(STATUSES)),
    text("created_at", required=True, format="date-time"),
    text("updated_at", format="date-time"),
    group(
        "progress",
        number("percentage", low=0, high=100),
        text("current_step"),
        text("estimated_completion", format="date-time"),
    ),
    group("error", text("message"), text("traceback"), integer("retry_count", low=0)),
    group(
        "metadata",
        group(
            "core",
            text("description", required=True, min_length=1),
            listing("volume_shape", integer("", low=1), min_items=2, max_items=4),
            Field(
                "voxel_size_nm",
                one_of=(
                    listing("", number("", low=0), min_items=2, max_items=4),
                    group("", number("x", low=0), number("y", low=0), number("z", low=0)),
                ),
            ),
            text("data_type", enum=tuple(DATA_TYPES)),
            text("modality", enum=tuple(MODALITIES)),
            text("imaging_start_date", format="date"),
            required=True,
        ),
        group(
            "technical",
            integer("file_size_bytes", low=0),
            text("sha256", pattern=SHA256_PATTERN),
            text("compression", enum=tuple(COMPRESSIONS)),
            listing("chunk_size", integer("", low=1)),
            text("dtype"),
            number("global_mean"),
            listing("dimensions_nm", number("", low=0)),
        ),
        group(
            "provenance",
            text("download_url", format="uri"),
            text("processing_pipeline"),
            text("internal_zarr_path"),
            text("uuid", format="uuid"),
        ),
        group(
            "quality",
            number("completeness_score", low=0, high=1),
            listing("validation_errors", text("")),
            group("metrics"),
        ),
        required=True,
    ),
    group("files", text("volume"), text("raw"), text("metadata"), group("additional")),
    group("additional_metadata"),
)

# Spark patterns for the optional strict check of ``format`` annotations.
FORMAT_PATTERNS = {
    "uuid": "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "date-time": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "uri": "^[A-Za-z][A-Za-z0-9+.-]*:[^ ]+$",
}
# ---------------------------------------------------------------------------
