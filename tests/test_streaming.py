import pytest
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.operators.features import flagged_stream_features, stream_features
from meterhawk.plans import samples
from meterhawk.sources import messages as ME
from meterhawk.sources import tables as TA
from meterhawk.sources import trips as SO
from meterhawk.sources.events import fleet_file
from meterhawk.streaming import state as ST
from meterhawk.streaming.job import RateListener, ScoringJob, batch_guard, batch_metrics, start_scoring

NOW = {"availableNow": True}


def write_messages(spark, sf_dir, path, files, small=None):
    """One file per micro-batch; file ``small`` holds only 5 rows."""
    trips = samples.trips(spark, sf_dir).filter("passenger_count IS NOT NULL")
    both = SO.merge_fleets(*[SO.project_source(fleet_file(trips, f), f) for f in S.FLEETS])
    rows = ME.encode(SO.zero_fill(SO.stringify_times(both))).collect()
    size = len(rows) // files
    for i in range(files):
        part = rows[i * size : i * size + (5 if i == small else size)]
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    """Eight files, one of them too small to count; retraining every third counted batch."""
    base = tmp_path_factory.mktemp("stream")
    write_messages(spark, sf_dir, f"{base}/drop", 8, small=2)
    job = ScoringJob(f"{base}/out", trees=10, sample=32, retrain_every=3, buffer_rows=150)
    listener = RateListener()
    spark.streams.addListener(listener)
    query = start_scoring(ME.read_drop_folder(spark, f"{base}/drop"), job, f"{base}/checkpoint", NOW)
    query.awaitTermination()
    return base, job, listener


def table(spark, run, name):
    return TA.read_results(spark, f"{run[0]}/out", name)


def batches(spark, run):
    return sorted(r.batch_id for r in table(spark, run, "pipeline_metrics").collect())


def test_small_batch_is_scored(spark, run):
    assert batches(spark, run) == list(range(8))
    small = table(spark, run, "pipeline_metrics").orderBy("records_processed").first()
    rows = table(spark, run, "scored_trips").filter(F.col("batch_id") == small.batch_id)
    assert small.records_processed <= 5 and rows.count() > 0
    assert rows.filter("anomaly_score IS NULL OR is_anomaly IS NULL").isEmpty()


def test_retrains_at_counted_batches(spark, run):
    rows = table(spark, run, "pipeline_metrics").orderBy("batch_id").collect()
    counted = [r for r in rows if batch_guard(r.records_processed, r.records_processed)]
    assert len(counted) == 7
    assert [i for i, r in enumerate(counted) if r.model_retrained] == [0, 3, 6]


def test_stream_result_equals_batch_result(spark, run):
    decoded = ME.decode_trips(spark.read.parquet(f"{run[0]}/drop"))
    whole = stream_features(decoded).select("trip_distance", "fare_amount", F.round("avg_speed_kmh", 6))
    stored = table(spark, run, "scored_trips").select("trip_distance", "fare_amount", F.round("avg_speed_kmh", 6))
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()


def test_tables_agree_with_each_other(spark, run):
    scored = table(spark, run, "scored_trips")
    anomalies = table(spark, run, "anomalous_trips")
    counts = {r.batch_id: r for r in table(spark, run, "pipeline_metrics").collect()}
    per_batch = scored.groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("is_anomaly").alias("k")).collect()
    for r in per_batch:
        assert counts[r.batch_id].anomalies_detected == r.k
        assert counts[r.batch_id].anomaly_rate == pytest.approx(r.k / r.n)
    assert anomalies.count() == scored.filter("is_anomaly = 1").count()
    assert anomalies.filter("reason IS NULL OR reason_code IS NULL").isEmpty()
    assert scored.filter("anomaly_score < 0 OR anomaly_score > 1").isEmpty()
    cols = [c for c in S.SCORED_TRIPS.fieldNames() if c in anomalies.columns]
    assert anomalies.select(cols).exceptAll(scored.select(cols)).isEmpty()


def test_batch_without_a_clean_row_leaves_its_metrics_only(spark, tmp_path):
    job = ScoringJob(f"{tmp_path}/out")
    raw = spark.createDataFrame([("no trip", "f", i) for i in range(7)], "value string, arrival_source string, arrival_pos long")
    features = flagged_stream_features(ME.decode_trips(raw))
    job(features, 4)
    job(features.limit(0), 5)
    (row,) = TA.read_results(spark, job.root, "pipeline_metrics").collect()
    assert (row.batch_id, row.records_processed, row.anomalies_detected, row.anomaly_rate) == (4, 7, 0, 0.0)
    assert TA.read_results(spark, job.root, "scored_trips").isEmpty() and ST.read_state(spark, job.root, 9) == ST.State()


def test_normal_sample_is_the_first_arrivals(spark, run):
    first = table(spark, run, "normal_trips")
    assert first.groupBy("batch_id").count().agg(F.max("count")).first()[0] == 50
    cut = first.groupBy("batch_id").agg(F.max("arrival_pos").alias("last"))
    earlier = table(spark, run, "scored_trips").filter("is_anomaly = 0").join(cut, "batch_id").filter("arrival_pos <= last")
    assert earlier.count() == first.count()


def test_buffer_holds_the_newest_rows(spark, run):
    root, last = f"{run[0]}/out", batches(spark, run)[-1]
    rows = ST.rolling_buffer(spark, root, last, 150)
    assert rows.count() == 150
    kept = {r.batch_id for r in rows.select("batch_id").distinct().collect()}
    assert last in kept and min(kept) >= last - 3


def test_replayed_batch_changes_nothing(spark, run):
    base, job, _ = run
    last = batches(spark, run)[-1]
    def content():
        cols = [c for c in S.SCORED_TRIPS.fieldNames() if c != "inserted_at"]
        return {n: table(spark, run, n).select(*[c for c in cols if c in table(spark, run, n).columns], "batch_id")
                .orderBy("batch_id", "arrival_source", "arrival_pos").collect()
                for n in ("scored_trips", "anomalous_trips", "normal_trips")}
    before = content()
    again = ScoringJob(job.root, trees=10, sample=32, retrain_every=3, buffer_rows=150)
    source = next(r.arrival_source for r in before["scored_trips"] if r.batch_id == last)
    raw = spark.read.schema("value string").parquet(source).select(
        "value", F.col("_metadata.file_path").alias("arrival_source"), F.col("_metadata.row_index").alias("arrival_pos")
    )
    again(flagged_stream_features(ME.decode_trips(raw)), last)
    assert content() == before
    assert table(spark, run, "pipeline_metrics").count() == 8


def test_listener_saw_the_batches(run):
    import time

    for _ in range(50):
        if len(run[2].rates) >= 8:
            break
        time.sleep(0.1)
    assert {r[0] for r in run[2].rates} >= set(range(8))


def test_warm_start_scores_without_training(spark, run, sf_dir, tmp_path):
    base, job, _ = run
    write_messages(spark, sf_dir, f"{tmp_path}/drop", 1)
    warm = ScoringJob(f"{tmp_path}/out", trees=10, sample=32, warm_root=job.root)
    start_scoring(ME.read_drop_folder(spark, f"{tmp_path}/drop"), warm, f"{tmp_path}/checkpoint", NOW).awaitTermination()
    row = TA.read_results(spark, f"{tmp_path}/out", "pipeline_metrics").first()
    assert not row.model_retrained and row.records_processed > 900


def test_rows_before_the_first_model_are_stored_then_scored(spark, sf_dir, tmp_path):
    write_messages(spark, sf_dir, f"{tmp_path}/drop", 8)
    every = [r.value for r in spark.read.parquet(f"{tmp_path}/drop").orderBy("value").limit(124).collect()]
    job = ScoringJob(f"{tmp_path}/out", trees=5, sample=16)

    def feed(batch_id, values):
        raw = spark.createDataFrame([(v, "f", batch_id * 1000 + i) for i, v in enumerate(values)], "value string, arrival_source string, arrival_pos long")
        features = flagged_stream_features(ME.decode_trips(raw))
        job(features, batch_id)
        return features.filter("is_clean").count()

    clean = [feed(0, every[:24]), feed(1, every[24:29])]
    assert ST.read_state(spark, job.root, 2) == ST.State(1, None)
    stored = TA.read_results(spark, job.root, "scored_trips")
    assert stored.count() == sum(clean) and stored.filter("is_anomaly IS NOT NULL OR if_score IS NOT NULL").isEmpty()
    assert stored.filter("(reason IS NULL) <> (reason_code IS NULL) OR reason_code = 'statistical'").isEmpty()
    assert TA.read_results(spark, job.root, "pipeline_metrics").isEmpty()

    clean.append(feed(2, every[29:123]))
    clean.append(feed(3, every[123:]))
    scored = TA.read_results(spark, job.root, "scored_trips")
    assert scored.count() == sum(clean)
    assert scored.filter("is_anomaly IS NULL OR anomaly_score IS NULL OR isnan(anomaly_score)").isEmpty()
    metrics = {r.batch_id: r for r in TA.read_results(spark, job.root, "pipeline_metrics").collect()}
    assert metrics[0].records_processed == 24 and metrics[1].records_processed == 5 and metrics[2].model_retrained
    assert ST.waiting_batches(spark, job.root, 10) == []


def test_raw_lake_keeps_every_trip(spark, run, tmp_path):
    stream = ME.decode_trips(ME.read_drop_folder(spark, f"{run[0]}/drop"))
    ME.write_raw_lake(stream, f"{tmp_path}/lake", f"{tmp_path}/ck").trigger(**NOW).start().awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/lake").count() == spark.read.parquet(f"{run[0]}/drop").count()


@pytest.mark.parametrize("processed, has_model, want", [
    (0, False, True), (7, False, True), (0, True, False), (24, True, False), (25, True, True), (26, True, False), (50, True, True),
])
def test_retrain_policy(processed, has_model, want):
    assert ST.should_retrain(ST.State(processed, 0), has_model) is want


def test_guard_and_metrics():
    assert batch_guard(10, 10) and not batch_guard(9, 9) and not batch_guard(100, 9)
    m = batch_metrics(1000, 800, 8, 2.0, True)
    assert m["anomaly_rate"] == 0.01 and m["throughput_eps"] == 500.0
    assert m["estimated_cost_usd"] == pytest.approx(2000 * 0.000016)
    assert batch_metrics(10, 0, 0, 0.0, False)["throughput_eps"] == 10 / 0.001


def test_default_buffer_is_bounded(spark):
    df = spark.range(12_000).select((F.col("id") / 1000).cast("long").alias("batch_id"), F.col("id").alias("arrival_pos"))
    kept = ST.newest(df, S.BUFFER_ROWS)
    assert kept.count() == 10_000 and kept.agg(F.min("arrival_pos")).first()[0] == 2000


def test_state_is_pruned(spark, tmp_path):
    for i in range(ST.STATES_KEPT + 3):
        ST.write_state(spark, str(tmp_path), i, ST.State(i + 1, None))
    assert ST.read_state(spark, str(tmp_path), 10**6) == ST.State(ST.STATES_KEPT + 3, None)
    assert len(list((tmp_path / "state").iterdir())) == ST.STATES_KEPT
