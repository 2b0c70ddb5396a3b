"""SQL twin of the record-file adapter: results from columns, without JSON."""

_ENUM_SOURCE = "[''ebi'', ''epfl'', ''flyem'', ''idr'', ''openorganelle'']"
_ENUM_STATUS = "[''pending'', ''processing'', ''saving-data'', ''complete'', ''failed'', ''cancelled'']"
_ENUM_TYPE = "[''uint8'', ''uint16'', ''uint32'', ''int8'', ''int16'', ''int32'', ''float32'', ''float64'']"

FILES = """
d AS (
  SELECT d.doc_id, d.text, d.n_chars, l.quality, d.doc_id % 29 AS kind,
         CASE d.doc_id % 6 WHEN 0 THEN 'ebi' WHEN 1 THEN 'epfl' WHEN 2 THEN 'flyem'
              WHEN 3 THEN 'idr' WHEN 4 THEN 'openorganelle' ELSE 'empiar' END AS src,
         sha256(d.text) AS sha, octet_length(encode(d.text)) AS bytes,
         TIMESTAMP '2024-01-01' + to_seconds((d.doc_id * 7919) % 100000) AS mtime,
         TIMESTAMP '2024-01-01' + to_seconds(d.doc_id % 86400) AS created
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
),
files AS (
  SELECT *, '/data/' || src || CASE WHEN doc_id % 23 = 5 THEN '/consolidate'
                                    WHEN doc_id % 10 = 7 THEN '/nested' ELSE '' END AS dir,
         CASE WHEN doc_id % 17 = 3 THEN 'note_' || doc_id || '.json'
              ELSE 'metadata_' || doc_id || '_20240101_' || lpad(CAST(doc_id % 240000 AS VARCHAR), 6, '0')
                   || CASE WHEN doc_id % 19 = 4 THEN '_draft.json' ELSE '.json' END END AS fname
  FROM d
),
cand AS (
  SELECT *, dir || '/' || fname AS file FROM files
  WHERE fname LIKE '%metadata%.json' AND NOT ends_with(fname, '_draft.json') AND NOT ends_with(dir, '/consolidate')
),
recs AS (
  SELECT *, kind <> 0 AS parsed, kind IN (0, 1, 26) AS load_failed,
         CASE WHEN kind IN (0, 1, 26) THEN 'unknown'
              WHEN kind IN (20, 21) AND src = 'empiar' THEN 'unknown' ELSE src END AS source
  FROM cand
)"""

VIOL = f"""
viol AS (
  SELECT doc_id, file, source, 0 AS depth, 0 AS weak, 1 AS ord, '' AS path, 'required' AS keyword,
         '''id'' is a required property' AS message FROM recs WHERE kind IN (2, 22)
  UNION ALL SELECT doc_id, file, source, 0, 0, 2, '', 'required', '''source'' is a required property' FROM recs WHERE kind = 20
  UNION ALL SELECT doc_id, file, source, 0, 0, 4, '', 'required', '''status'' is a required property' FROM recs WHERE kind = 22 AND doc_id % 3 <> 0
  UNION ALL SELECT doc_id, file, source, 0, 0, 5, '', 'required', '''created_at'' is a required property' FROM recs WHERE kind IN (22, 25)
  UNION ALL SELECT doc_id, file, source, 0, 0, 6, '', 'required', '''metadata'' is a required property' FROM recs WHERE kind = 22
  UNION ALL SELECT doc_id, file, source, 1, 0, 10, 'id', 'type', 'null is not of type ''string''' FROM recs WHERE kind = 3
  UNION ALL SELECT doc_id, file, source, 1, 0, 11, 'source', 'enum', '''empiar'' is not one of {_ENUM_SOURCE}'
            FROM recs WHERE src = 'empiar' AND kind NOT IN (0, 1, 20, 21, 26)
  UNION ALL SELECT doc_id, file, source, 1, 0, 11, 'source', 'enum', ''''' is not one of {_ENUM_SOURCE}' FROM recs WHERE kind = 21
  UNION ALL SELECT doc_id, file, source, 1, 0, 13, 'status', 'enum', '''done'' is not one of {_ENUM_STATUS}' FROM recs WHERE kind IN (4, 27)
  UNION ALL SELECT doc_id, file, source, 2, 0, 17, 'progress.percentage', 'maximum', '120 is greater than the maximum of 100' FROM recs WHERE kind = 15
  UNION ALL SELECT doc_id, file, source, 2, 0, 17, 'progress.percentage', 'type', 'true is not of type ''number''' FROM recs WHERE kind = 16
  UNION ALL SELECT doc_id, file, source, 2, 0, 19, 'error.retry_count', 'minimum', '-1 is less than the minimum of 0' FROM recs WHERE kind = 23
  UNION ALL SELECT doc_id, file, source, 1, 0, 20, 'metadata', 'type', '''flat'' is not of type ''object''' FROM recs WHERE kind = 19
  UNION ALL SELECT doc_id, file, source, 1, 0, 21, 'metadata', 'required', '''core'' is a required property' FROM recs WHERE kind = 17
  UNION ALL SELECT doc_id, file, source, 2, 0, 22, 'metadata.core', 'required', '''description'' is a required property' FROM recs WHERE kind = 18
  UNION ALL SELECT doc_id, file, source, 3, 0, 23, 'metadata.core.description', 'minLength', ''''' is too short' FROM recs WHERE kind = 5
  UNION ALL SELECT doc_id, file, source, 4, 0, 24, 'metadata.core.volume_shape[0]', 'type', '2.5 is not of type ''integer''' FROM recs WHERE kind = 10
  UNION ALL SELECT doc_id, file, source, 4, 0, 25, 'metadata.core.volume_shape[1]', 'minimum', '0 is less than the minimum of 1' FROM recs WHERE kind = 8
  UNION ALL SELECT doc_id, file, source, 3, 0, 26, 'metadata.core.volume_shape', 'minItems', '[' || (doc_id + 1) || '] is too short' FROM recs WHERE kind = 6
  UNION ALL SELECT doc_id, file, source, 3, 0, 27, 'metadata.core.volume_shape', 'maxItems', '[2,2,2,2,2] is too long' FROM recs WHERE kind = 7
  UNION ALL SELECT doc_id, file, source, 3, 1, 28, 'metadata.core.voxel_size_nm', 'oneOf', '''4x4x4'' is not valid under any of the given schemas' FROM recs WHERE kind = 12
  UNION ALL SELECT doc_id, file, source, 3, 1, 28, 'metadata.core.voxel_size_nm', 'oneOf', '{{"x":-1,"y":4}} is not valid under any of the given schemas' FROM recs WHERE kind = 13
  UNION ALL SELECT doc_id, file, source, 3, 0, 29, 'metadata.core.data_type', 'enum', '''float16'' is not one of {_ENUM_TYPE}' FROM recs WHERE kind = 27
  UNION ALL SELECT doc_id, file, source, 3, 0, 33, 'metadata.technical.sha256', 'pattern', '''' || upper(sha) || ''' does not match ''^[a-f0-9]{{64}}$''' FROM recs WHERE kind IN (14, 27)
  UNION ALL SELECT doc_id, file, source, 3, 0, 36, 'metadata.quality.completeness_score', 'maximum', '1.5 is greater than the maximum of 1' FROM recs WHERE kind = 24
  UNION ALL SELECT doc_id, file, source, 4, 0, 37, 'metadata.quality.validation_errors[0]', 'type', '1 is not of type ''string''' FROM recs WHERE kind = 24
)"""

RESULTS = """
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth, weak, ord) AS rn FROM viol
  ) WHERE rn = 1
),
results AS (
  SELECT r.*, b.keyword, b.path,
         CASE WHEN NOT r.parsed THEN 'parse' WHEN r.load_failed THEN 'processing'
              WHEN b.doc_id IS NOT NULL THEN 'schema' END AS error_class,
         CASE WHEN r.kind = 0 THEN 'JSON parsing error'
              WHEN r.kind = 1 THEN 'Processing error: ''list'' object has no attribute ''get'''
              WHEN r.kind = 26 THEN 'Processing error: unhashable type: ''list'''
              WHEN b.keyword = 'oneOf' AND r.kind = 13 THEN '-1 is less than the minimum of 0'
              ELSE b.message END AS error,
         NOT r.load_failed AND b.doc_id IS NULL AS valid
  FROM recs r LEFT JOIN best b ON b.doc_id = r.doc_id
)"""

KEYS = """
keys AS (
  SELECT r.doc_id, r.file, r.source, k.key
  FROM recs r CROSS JOIN (VALUES ('id'), ('source'), ('source_id'), ('status'), ('created_at'), ('updated_at'),
    ('metadata'), ('progress'), ('error'), ('local_paths'), ('additional_metadata'), ('description'), ('timestamp'),
    ('volume_shape'), ('dtype'), ('file_size_bytes'), ('sha256'), ('voxel_size_nm'), ('dimensions_nm')) k(key)
  WHERE NOT r.load_failed AND CASE
    WHEN r.kind = 22 THEN k.key IN ('source', 'source_id', 'description', 'volume_shape', 'dtype', 'file_size_bytes',
                                    'sha256', 'voxel_size_nm', 'dimensions_nm', 'local_paths')
         OR (k.key = 'timestamp' AND r.doc_id % 2 = 0) OR (k.key = 'status' AND r.doc_id % 3 = 0)
    WHEN k.key = 'id' THEN r.kind <> 2
    WHEN k.key = 'source' THEN r.kind <> 20
    WHEN k.key = 'created_at' THEN r.kind <> 25
    WHEN k.key = 'progress' THEN r.kind IN (15, 16)
    WHEN k.key = 'error' THEN r.kind = 23
    WHEN k.key IN ('local_paths', 'additional_metadata') THEN r.kind = 28
    ELSE k.key IN ('source_id', 'status', 'updated_at', 'metadata') END
)"""


def with_files(body: str) -> str:
    return f"WITH {FILES}\n{body}"


def with_viol(body: str) -> str:
    return f"WITH {FILES},\n{VIOL}\n{body}"


def with_results(body: str) -> str:
    return f"WITH {FILES},\n{VIOL},\n{RESULTS}\n{body}"


def with_keys(body: str) -> str:
    return f"WITH {FILES},\n{VIOL},\n{RESULTS},\n{KEYS}\n{body}"
