"""Micro-batch scoring: buffer, retrain, score, vote, explain, store, measure.

Every clean row of every batch is stored. A small batch is scored like any other; it only does not set off or count
towards a retraining. A batch without a clean row leaves its metrics only. While no model exists, rows are stored without a score, with the reason of the rule they
break, and kept whole aside; the first model scores them and puts them in their batch's place. These are fewer
rows than a first training needs.

Row-wise work (decoding, features, the validity flag) runs ahead of ``foreachBatch`` as one plan. The
callback works on one cached frame; only counts and score extremes reach the driver.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from meterhawk import schema as S
from meterhawk.functions import rules
from meterhawk.operators.features import flagged_stream_features, split
from meterhawk.operators.normalise import combined_score
from meterhawk.operators.training import retrain_contamination, score_ensemble, train_ensemble
from meterhawk.sources import tables
from meterhawk.sources.messages import decode_trips
from meterhawk.sources.models import Model, latest_model, load_model, save_model
from meterhawk.streaming import state as ST


def batch_counts(df: DataFrame, flag: str = "is_clean") -> tuple[int, int]:
    """(all rows, rows where the flag holds) in one aggregate."""
    row = df.agg(F.count("*").alias("n"), F.count_if(F.col(flag)).alias("k")).first()
    return row["n"], row["k"]


def batch_guard(raw: int, clean: int, n: int = S.MIN_BATCH_ROWS) -> bool:
    """Whether a batch has enough rows to count towards a retraining."""
    return raw >= n and clean >= n


def batch_metrics(records: int, clean: int, anomalies: int, seconds: float, retrained: bool) -> dict:
    ms = seconds * 1000
    return {
        "records_processed": records,
        "anomalies_detected": anomalies,
        "anomaly_rate": anomalies / max(clean, 1),
        "processing_time_ms": ms,
        "throughput_eps": records / max(seconds, 0.001),
        "estimated_cost_usd": ms * S.COST_USD_PER_MS,
        "model_retrained": retrained,
    }


def explain_scores(scored: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """Add the combined score and, for anomalies, the reason and its code."""
    scored = scored.withColumn("anomaly_score", combined_score(bounds))
    broken = F.col("is_anomaly") == 1
    return scored.withColumns(
        {"reason": F.when(broken, rules.reason()), "reason_code": F.when(broken, rules.reason_code())}
    )


def unscored(clean: DataFrame) -> DataFrame:
    """Rows to store before any model exists: no score or flag, but the reason of a broken rule."""
    df = clean.withColumn("anomaly_score", F.lit(None).cast("double"))
    broken = rules.violates()
    return df.withColumns({"reason": F.when(broken, rules.reason()), "reason_code": F.when(broken, rules.reason_code())})


def at_once(spark: SparkSession, *actions) -> None:
    """Run independent Spark actions side by side; the first failure is raised."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(actions)) as pool:
        for done in [pool.submit(inherit(action)) for action in actions]:
            done.result()


@dataclass
class ScoringJob:
    """``foreachBatch`` callback. ``warm_root`` names another run whose newest model starts this one."""

    root: str
    mode: str = "strict"
    trees: int = S.STREAM_TREES
    sample: int = S.STREAM_SAMPLE
    retrain_every: int = S.RETRAIN_EVERY
    buffer_rows: int = S.BUFFER_ROWS
    min_training_rows: int = S.MIN_TRAINING_ROWS
    warm_root: str | None = None
    _held: tuple[int, Model] | None = field(default=None, repr=False)
    _left: tuple[int, ST.State] | None = field(default=None, repr=False)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._process(batch, batch_id)
        finally:
            batch.unpersist()

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = batch.sparkSession
        records, clean_rows = batch_counts(batch)
        if not clean_rows:
            if records:
                metrics = batch_metrics(records, 0, 0, time.time() - started, False)
                tables.write_metrics(spark, self.root, batch_id, metrics)
            return
        counts = batch_guard(records, clean_rows)
        clean = batch.filter("is_clean")
        state = ST.read_state(spark, self.root, batch_id, self._left)
        held = self._current_model(spark, state, batch_id)

        def buffer() -> None:
            ST.append_buffer(clean, self.root, batch_id, clean_rows, self.buffer_rows)

        beside = []
        retrained = False
        if ST.should_retrain(state, held is not None, self.retrain_every) and (counts or held is None):
            buffer()
            fresh = self._retrain(spark, batch_id, held[1] if held else None)
            retrained = fresh is not None
            if held is None and fresh:
                self._score_waiting(spark, fresh[1], batch_id)
            held = fresh or held
        else:
            beside.append(buffer)
        after = ST.State(state.processed_batches + counts, held[0] if held else None)
        if held is None:
            at_once(
                spark,
                lambda: ST.put_waiting(clean, self.root, batch_id, records),
                lambda: tables.write_batch(tables.to_stored(unscored(clean)), self.root, "scored_trips", batch_id, clean_rows),
            )
            self._leave(spark, batch_id, after)
            return

        self._held = held
        found = self._store(clean, held[1], batch_id, clean_rows, beside)
        metrics = batch_metrics(records, clean_rows, found, time.time() - started, retrained)
        at_once(
            spark,
            lambda: tables.write_metrics(spark, self.root, batch_id, metrics),
            lambda: self._leave(spark, batch_id, after),
        )

    def _store(self, clean: DataFrame, model: Model, batch_id: int, rows: int, beside=()) -> int:
        """Score, explain and store the rows of one batch, with other actions beside; returns its anomalies."""
        spark = clean.sparkSession
        scored = score_ensemble(clean, model, self.mode).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bounds = scored.agg(
                F.sum("is_anomaly").alias("anomalies"),
                *[
                    f(c).alias(f"{c}_{n}")
                    for c in ("if_score", "mah_distance")
                    for n, f in (("min", F.min), ("max", F.max))
                ],
            ).first()
            found = bounds["anomalies"]
            # One instant for the three tables, which are written side by side from the scored rows.
            explained = tables.to_stored(explain_scores(scored, bounds.asDict()), datetime.now(timezone.utc))
            anomalies, normals = split(explained)
            order = ["arrival_pos", "arrival_source"]
            at_once(
                spark,
                lambda: tables.write_batch(explained, self.root, "scored_trips", batch_id, rows),
                lambda: tables.write_anomalies(anomalies, self.root, batch_id, found),
                lambda: tables.write_normal_sample(normals, self.root, batch_id, order),
                *beside,
            )
        finally:
            scored.unpersist()
        return found

    def _score_waiting(self, spark: SparkSession, model: Model, batch_id: int) -> None:
        """Score the batches stored before the first model."""
        for waiting in ST.waiting_batches(spark, self.root, batch_id):
            started = time.time()
            rows, records = ST.read_waiting(spark, self.root, waiting)
            n = rows.count()
            found = self._store(rows, model, waiting, n)
            metrics = batch_metrics(records, n, found, time.time() - started, False)
            tables.write_metrics(spark, self.root, waiting, metrics)
            ST.drop_waiting(spark, self.root, waiting)

    def _leave(self, spark: SparkSession, batch_id: int, state: ST.State) -> None:
        ST.write_state(spark, self.root, batch_id, state)
        self._left = (batch_id, state)

    def _current_model(self, spark: SparkSession, state: ST.State, batch_id: int) -> tuple[int, Model] | None:
        version = state.model_version
        if version is not None and self._held and self._held[0] == version:
            return self._held
        if version is not None and version >= 0:
            model = load_model(spark, self.root, version)
            if model:
                return version, model
        found = latest_model(spark, self.root, batch_id - 1)
        if found is None and self.warm_root:
            warm = latest_model(spark, self.warm_root, own=False)
            found = (-1, warm[1]) if warm else None
        return found

    def _retrain(self, spark: SparkSession, batch_id: int, previous: Model | None) -> tuple[int, Model] | None:
        rows = ST.rolling_buffer(spark, self.root, batch_id, self.buffer_rows)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            span = rows.agg(F.count("*").alias("n"), F.min("batch_id").alias("oldest")).first()
            if span["n"] < self.min_training_rows:
                return None
            contamination = retrain_contamination(rows, previous)
            key = ["batch_id", *ST.ARRIVAL]
            nodes, model = train_ensemble(rows, key, contamination, self.trees, self.sample)
            save_model(spark, self.root, batch_id, nodes, model)
        finally:
            rows.unpersist()
        ST.trim_buffer(spark, self.root, span["oldest"])
        return batch_id, model


def start_scoring(
    messages: DataFrame, job: ScoringJob, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start scoring a stream of messages. Without a trigger, batches run back to back until stopped."""
    features = flagged_stream_features(decode_trips(messages))
    writer: DataStreamWriter = (
        features.writeStream.foreachBatch(job).outputMode("append").option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


class RateListener(StreamingQueryListener):
    """Keeps the last source rates Spark reports per batch."""

    def __init__(self, kept: int = 1000):
        self.kept = kept
        self.rates: list[tuple[int, float, float]] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.rates.append((p.batchId, p.inputRowsPerSecond, p.processedRowsPerSecond))
        del self.rates[: -self.kept]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
