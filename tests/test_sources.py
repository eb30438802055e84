import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhawk import schema as S
from meterhawk.operators.features import stream_features
from meterhawk.plans import labeling as LA
from meterhawk.plans import samples
from meterhawk.session import shared_dir, stage
from meterhawk.sources import messages as ME
from meterhawk.sources import tables as TA
from meterhawk.sources import trips as SO
from meterhawk.sources.events import fleet_file


@pytest.fixture(scope="module")
def files(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    trips = samples.trips(spark, sf_dir)
    for fleet in S.FLEETS:
        fleet_file(trips, fleet).withColumn("tip_amount", F.lit(1.0)).write.parquet(f"{root}/{fleet}")
    return {fleet: f"{root}/{fleet}" for fleet in S.FLEETS}


@pytest.mark.parametrize("fleet", [*S.FLEETS, None])
def test_trip_scan_prunes_columns(spark, files, fleet):
    df = SO.read_trips(spark, files[fleet or "yellow"], fleet)
    assert set(df.columns) == {
        "VendorID", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "fare_amount",
    } | ({"taxi_type"} if fleet else set())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "tip_amount" not in plan and "trip_id" not in plan


def test_filters_reach_the_scan(spark, files):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    df = stream_features(SO.read_trips(spark, files["green"], "green"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(trip_distance,0.1)" in plan and "GreaterThan(fare_amount,0.0)" in plan


def test_full_scan_identifies_rows(spark, files):
    df = SO.read_trips(spark, files["green"], "green", columns=None)
    assert df.select("_row_source", "_row_pos").distinct().count() == df.count()
    assert "tip_amount" in df.columns


def test_label_job_writes_labels_that_can_be_read_back(spark, files, tmp_path):
    target = f"{tmp_path}/green_labelled"
    totals = LA.label_trips(spark, files["green"], target, "green", trees=20).first()
    written = spark.read.parquet(target)
    source = spark.read.parquet(files["green"])
    assert totals.total == source.count() == written.count()
    assert set(source.columns) <= set(written.columns) and "_row_pos" not in written.columns
    assert written.filter("ai_anomaly_score < 0 OR ai_anomaly_score > 1").isEmpty()
    assert written.filter("(is_anomaly = 1) <> (ai_reason IS NOT NULL)").isEmpty()
    outliers = written.filter("ai_reason LIKE '[AI_OUTLIER]%'").count()
    assert outliers <= 0.02 * totals.total + 1
    labels = SO.read_labels(spark, {"green": target, "yellow": f"{tmp_path}/none"})
    assert labels.count() == totals.total and set(labels.select("taxi_type").distinct().toPandas().taxi_type) == {"green"}
    assert SO.read_labels(spark, {"yellow": f"{tmp_path}/none"}) is None


def test_labelling_is_repeatable(spark, files):
    runs = []
    for parts in (1, 7):
        df = SO.read_trips(spark, files["green"], "green", columns=None).repartition(parts)
        labelled, _ = LA.label_frame(df, "green", trees=10)
        runs.append(labelled.select("trip_id", "is_anomaly", "ai_anomaly_score", "ai_reason").orderBy("trip_id").collect())
    assert runs[0] == runs[1]


def decode(spark, *texts):
    return ME.decode_trips(spark.createDataFrame([(t,) for t in texts], "value string")).collect()


def test_decode_shapes(spark):
    current, old, green, integer, gaps, nan, junk = decode(
        spark,
        '{"taxi_type":"green","VendorID":2,"pickup_datetime":"2024-01-01 00:00:00","dropoff_datetime":"NaT",'
        '"passenger_count":1.0,"trip_distance":2.5,"fare_amount":9.0,"extra":1}',
        '{"VendorID":1,"tpep_pickup_datetime":"2024-01-01 00:00:00","tpep_dropoff_datetime":"2024-01-01 00:10:00","fare_amount":9}',
        '{"VendorID":1,"lpep_pickup_datetime":"2024-01-01 00:00:00"}',
        '{"VendorID":2.0}',
        "{}",
        '{"fare_amount":NaN}',
        "not json",
    )
    assert (current.taxi_type, current.VendorID, current.dropoff_datetime) == ("green", 2, "NaT")
    assert (old.taxi_type, old.pickup_datetime, old.fare_amount) == ("yellow", "2024-01-01 00:00:00", 9.0)
    assert green.taxi_type == "green"
    assert integer.VendorID == 2
    assert all(v is None for v in gaps) and all(v is None for v in junk)
    assert nan.fare_amount != nan.fare_amount


def test_decode_reads_only_what_is_used(spark):
    df = ME.decode_trips(spark.createDataFrame([("{}",)], "value string")).select("fare_amount")
    assert "tpep_pickup_datetime" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_stream_and_publish_options():
    options = ME.stream_options("broker:9092")
    assert options["subscribe"] == "taxi_stream" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "5000"
    assert ME.stream_options("b", maxOffsetsPerTrigger="10")["maxOffsetsPerTrigger"] == "10"
    assert ME.publish_options("b", ME.ANOMALY_TOPIC)["topic"] == "taxi_anomalies"
    jdbc = TA.jdbc_options("jdbc:postgresql://h/db", "normal_trips", "u", "p", batchsize="500")
    assert jdbc["dbtable"] == "normal_trips" and jdbc["batchsize"] == "500"


def test_result_tables_are_created_kept_and_dropped(spark, tmp_path):
    root = str(tmp_path)
    TA.create_result_tables(spark, root)
    TA.write_metrics(spark, root, 4, {
        "records_processed": 10, "anomalies_detected": 1, "anomaly_rate": 0.1, "processing_time_ms": 5.0,
        "throughput_eps": 2.0, "estimated_cost_usd": 0.1, "model_retrained": True,
    })
    TA.create_result_tables(spark, root)
    TA.create_result_tables(spark, f"{root}/other")
    assert spark.table("pipeline_metrics").count() == 1
    row = spark.table("pipeline_metrics").first()
    assert (row.batch_id, row.records_processed, row.model_retrained) == (4, 10, True)
    TA.drop_result_tables(spark, root)
    assert not any(spark.catalog.tableExists(t) for t in S.RESULT_TABLES)
    assert TA.read_results(spark, root, "pipeline_metrics").isEmpty()


def test_database_reads_must_be_split(spark):
    with pytest.raises(ValueError, match="numPartitions"):
        TA.read_jdbc(spark, TA.jdbc_options("jdbc:postgresql://h/db", "t", "u", "p", partitionColumn="batch_id"))


def test_old_files_gain_new_columns(spark, tmp_path):
    path = f"{tmp_path}/normal_trips/batch_id=0"
    spark.range(3).select(F.lit("green").alias("taxi_type"), F.lit(9.0).alias("fare_amount")).write.parquet(path)
    df = TA.read_results(spark, str(tmp_path), "normal_trips")
    assert df.filter("fare_per_mile IS NULL AND fare_amount = 9 AND batch_id = 0").count() == 3


def test_evolve_casts_and_orders(spark):
    df = spark.createDataFrame([("7", 1)], "b string, a int")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.DoubleType())])
    assert [tuple(r) for r in TA.evolve(df, schema).collect()] == [(1, 7, None)]


def test_stringified_times(spark):
    rows = [(datetime.datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp, dropoff_datetime timestamp")
    assert tuple(SO.stringify_times(df).first()) == ("2024-01-01 00:00:00", "NaT")


def test_staging_uses_the_named_folder(spark):
    df, path = stage(spark.range(5).toDF("x"), "numbers")
    assert path.startswith(shared_dir(spark)) and df.count() == 5
