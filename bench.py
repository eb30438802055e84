"""Headline queries at one scale, as one JSON line: seconds per query (median) and stream throughput."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from meterhawk.plans import catalog, samples
from meterhawk.session import build_session
from meterhawk.sources import messages as ME
from meterhawk.sources import tables as TA
from meterhawk.sources import trips as SO
from meterhawk.sources.events import fleet_file
from meterhawk.streaming.job import ScoringJob, start_scoring

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

LIGHT = [
    "rule_counts",
    "guard_counts",
    "source_message_round_trip",
    "reason_texts",
    "label_votes",
    "deduplicated_labels",
    "label_matches",
    "evaluation_report",
    "reason_share",
    "fleet_kpis",
    "score_separation",
    "class_histograms",
    "combined_scores",
    "scaler_parameters",
    "latest_anomalies",
    "recent_metric_rows",
    "training_buffer",
]
HEAVY = ["forest_training", "forest_scoring", "covariance_fit", "ensemble_scoring", "permutation_sensitivity", "offline_labelling"]
STREAM_FILES = 8


def run_query(spark, name: str) -> float:
    started = time.perf_counter()
    catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def run_stream(spark) -> dict[str, float]:
    """Score the trips as a stream of files; the first batch trains, the rest give the rates."""
    base = tempfile.mkdtemp(prefix="meterhawk-bench-")
    trips = samples.trips(spark, SF_DIR)
    both = SO.merge_fleets(*[SO.project_source(fleet_file(trips, f), f) for f in ("yellow", "green")])
    ME.encode(SO.zero_fill(SO.stringify_times(both))).repartition(STREAM_FILES).write.parquet(f"{base}/drop")
    started = time.perf_counter()
    query = start_scoring(
        ME.read_drop_folder(spark, f"{base}/drop"), ScoringJob(f"{base}/out"), f"{base}/ck", {"availableNow": True}
    )
    query.awaitTermination()
    seconds = time.perf_counter() - started
    rows = TA.read_results(spark, f"{base}/out", "pipeline_metrics").orderBy("batch_id").collect()
    steady = [r for r in rows if not r.model_retrained]
    return {
        "stream_seconds": seconds,
        "stream_rows_per_sec": sum(r.records_processed for r in rows) / seconds,
        "batch_rows_per_sec": statistics.median(r.throughput_eps for r in steady),
        "batch_seconds": statistics.median(r.processing_time_ms for r in steady) / 1000,
        "training_batch_seconds": rows[0].processing_time_ms / 1000,
    }


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]", "meterhawk-bench", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in LIGHT + HEAVY:
        run_query(spark, name)
        seconds[name] = round(statistics.median(run_query(spark, name) for _ in range(RUNS if name in LIGHT else 1)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    stream = {k: round(v, 3) for k, v in run_stream(spark).items()}
    seconds["stream_scoring"] = stream["stream_seconds"]
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "stream": stream,
                "trips": rows,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
