"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_VOLUME_MB  size of a made volume whose block operators are timed too; their
               MB/s are in the JSON line (default 256; 0: off)
BENCH_STORE_DIR  where that volume is stored (default: a temporary folder)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from voxledger.session import local_session
from voxledger.suite import all_queries

HEADLINE = [
    "record_scan_parse", "violations_all", "errors_by_source", "key_ratios", "completeness", "processing_summary",
    "legacy_migrate_counts", "record_build", "deep_merge", "dup_sha256", "chunk_plan_memory", "chunk_grid",
    "vol_stats", "vol_bytes", "tree_digest", "pyramid", "rechunk", "block_lookup", "crop_blocks", "emb_topk",
    "status_latest", "retry_count", "running_eta", "interval_speed", "run_summary", "log_outcome", "stuck_runs",
    "fallback", "stream_status", "stream_access",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    run(spark.read.parquet(f"{sf_dir}/events.parquet"))
    run(queries["errors_by_source"](spark, sf_dir))  # start the JVM's compilers and the Python workers
    run(queries["vol_stats"](spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    megabytes = int(os.environ.get("BENCH_VOLUME_MB", "256"))
    volume = time_volume(spark, megabytes) if megabytes else {}
    seconds |= {name: round(took, 3) for name, took in volume.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "volume_mb_per_second": {n: round(megabytes / t) for n, t in volume.items()}, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


def time_volume(spark, megabytes: int) -> dict[str, float]:
    """Seconds of the block operators on one uint8 volume of 128-edge blocks."""
    import numpy as np
    import pyarrow as pa

    from voxledger.operators import blocks as B
    from voxledger.operators import store as K

    schema = B._arrow_schema(B.BLOCKS)

    def fill(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                idx = [i // 16, i // 4 % 4, i % 4]
                payload = np.random.default_rng(i).integers(0, 255, 1 << 21, "uint8").tobytes()
                row = {
                    "dataset_id": "v", "array_name": "s0", "level": 0, "chunk": [128] * 3, "idx": idx, "origin": [n * 128 for n in idx],
                    "shape": [128] * 3, "dtype": "uint8", "payload": payload,
                }
                yield pa.RecordBatch.from_pylist([row], schema)

    blocks = spark.range(megabytes // 2, numPartitions=64).mapInArrow(fill, B.BLOCKS)
    path = (os.environ.get("BENCH_STORE_DIR") or tempfile.mkdtemp(prefix="bench-volume-")) + "/blocks"
    took: dict[str, float] = {}

    def timed(label, work):
        start = time.perf_counter()
        work()
        took[f"volume_{label}"] = time.perf_counter() - start

    timed("store", lambda: K.write_blocks(blocks, path, spread=False))
    stored = K.read_blocks(spark, path)
    timed("statistics", lambda: B.volume_stats(stored).collect())
    timed("stride", lambda: run(B.stride(stored, 4)))
    timed("sha256", lambda: run(B.block_digests(stored)))
    timed("rechunk", lambda: run(B.rechunk(stored, [64, 64, 64])))
    return took


if __name__ == "__main__":
    main()
