"""Registered queries, each with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions import grades, rules
from meterhawk.functions import trips as X
from meterhawk.operators import covariance as CO
from meterhawk.operators import ensemble as EN
from meterhawk.operators import features as FE
from meterhawk.operators import forest as FO
from meterhawk.operators import histogram as HI
from meterhawk.operators import matching as MA
from meterhawk.operators import normalise as NO
from meterhawk.operators import quantiles as QU
from meterhawk.operators import scaler as SC
from meterhawk.operators import training as TR
from meterhawk.plans import dashboard as DA
from meterhawk.plans import diagnostics as DI
from meterhawk.plans import evaluation as EV
from meterhawk.plans import labeling as LA
from meterhawk.plans import oracles as O
from meterhawk.plans import samples as P
from meterhawk.session import stage
from meterhawk.sources import messages as ME
from meterhawk.sources import tables as TA
from meterhawk.sources import trips as SO
from meterhawk.sources.events import fleet_file
from meterhawk.streaming import state as ST

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TIME = "yyyy-MM-dd HH:mm:ss"
SQL_TIME = "'%Y-%m-%d %H:%M:%S'"


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, TIME) for c in columns})


def text_sql(*columns: str) -> str:
    return ", ".join(f"strftime({c}, {SQL_TIME}) AS {c}" for c in columns)


TIMES = ("pickup_datetime", "dropoff_datetime")
MEASURES = "passenger_count, trip_distance, fare_amount"

# --- Sources -------------------------------------------------------------------------------------


def _source_sql(fleet: str) -> str:
    return (
        O.TRIPS
        + f"SELECT VendorID, {text_sql(*TIMES)}, {MEASURES}, taxi_type FROM trips WHERE taxi_type = '{fleet}'"
    )


@query(_source_sql("yellow"))
def source_yellow_trips(spark, d):
    return as_text(SO.project_source(fleet_file(P.trips(spark, d), "yellow"), "yellow"), *TIMES)


@query(_source_sql("green"))
def source_green_trips(spark, d):
    return as_text(SO.project_source(fleet_file(P.trips(spark, d), "green"), "green"), *TIMES)


@query(
    O.TRIPS + f"SELECT VendorID, {text_sql(*TIMES)}, {MEASURES} FROM trips WHERE taxi_type = 'yellow'"
)
def source_legacy_trips(spark, d):
    return as_text(SO.project_source(fleet_file(P.trips(spark, d), "yellow"), None), *TIMES)


FULL_WIDTH_SQL = ", ".join(
    f"CASE WHEN taxi_type = '{f}' THEN strftime({logical}, {SQL_TIME}) END AS {source}"
    for f in S.FLEETS
    for source, logical in SO.time_columns(f).items()
)


@query(
    O.TRIPS
    + f"""SELECT trip_id, VendorID, {FULL_WIDTH_SQL}, {MEASURES} FROM trips"""
)
def source_full_width_trips(spark, d):
    """Every column of both fleets' files, under the names of the files."""
    files = [fleet_file(P.trips(spark, d), f) for f in S.FLEETS]
    both = files[0].unionByName(files[1], allowMissingColumns=True)
    return as_text(both, *[source for f in S.FLEETS for source in SO.time_columns(f)])


@query(
    O.LABELS
    + f"""SELECT taxi_type, {text_sql("pickup_datetime")}, trip_distance, fare_amount, is_anomaly,
    ai_anomaly_score, ai_reason, trip_id FROM labels"""
)
def source_labels(spark, d):
    return as_text(P.labels(spark, d), "pickup_datetime")


@query(
    O.TRIPS
    + f"SELECT taxi_type, CAST(VendorID AS BIGINT) AS VendorID, {text_sql(*TIMES)}, "
    + "coalesce(passenger_count, 0e0) AS passenger_count, trip_distance, fare_amount FROM trips"
)
def source_message_round_trip(spark, d):
    """Encode both fleets as the producers do, then decode."""
    trips = P.trips(spark, d)
    fleets = [SO.project_source(fleet_file(trips, f), f) for f in S.FLEETS]
    return ME.decode_trips(ME.encode(SO.zero_fill(SO.stringify_times(SO.merge_fleets(*fleets)))))


@query(
    O.TRIPS
    + f"""SELECT taxi_type, VendorID, {text_sql(*TIMES)}, {MEASURES} FROM trips WHERE taxi_type = 'yellow'
    AND passenger_count IS NOT NULL
    UNION ALL SELECT taxi_type, VendorID, {text_sql(*TIMES)}, 0e0, trip_distance, fare_amount FROM trips
    WHERE taxi_type = 'yellow' AND passenger_count IS NULL"""
)
def source_legacy_messages(spark, d):
    """Messages under the source names and without a fleet."""
    old = SO.project_source(fleet_file(P.trips(spark, d), "yellow"), None)
    old = SO.zero_fill(SO.stringify_times(old))
    names = {logical: source for source, logical in SO.time_columns("yellow").items()}
    return ME.decode_trips(ME.encode(old.withColumnsRenamed(names)))


@query(
    O.TRIPS
    + f"""SELECT '{{"VendorID":' || VendorID || ',"pickup_datetime":"' || strftime(pickup_datetime, {SQL_TIME})
    || '","dropoff_datetime":"' || strftime(dropoff_datetime, {SQL_TIME}) || '","passenger_count":'
    || CAST(coalesce(passenger_count, 0e0) AS VARCHAR) || ',"trip_distance":' || CAST(trip_distance AS VARCHAR)
    || ',"fare_amount":' || CAST(fare_amount AS VARCHAR) || ',"taxi_type":"' || taxi_type || '"}}' AS value FROM trips"""
)
def message_encoding(spark, d):
    fleets = [SO.project_source(fleet_file(P.trips(spark, d), f), f) for f in S.FLEETS]
    return ME.encode(SO.zero_fill(SO.stringify_times(SO.merge_fleets(*fleets))))


@query(
    O.SCORED
    + f"""SELECT batch_id, taxi_type, CAST(VendorID AS INT) AS VendorID, {text_sql(*TIMES)},
    CAST(passenger_count AS INT) AS passenger_count, trip_distance, fare_amount,
    CAST(trip_duration_sec AS INT) AS trip_duration_sec, {O.rounded("avg_speed_kmh", "fare_per_mile", digits=9)},
    anomaly_score, reason FROM anomalies"""
)
def stored_anomalies(spark, d):
    """Anomalous trips cast to the columns their table stores."""
    _, anomalies = P.results(spark, d)
    stored = TA.evolve(TA.to_stored(anomalies), S.ANOMALOUS_TRIPS).columns
    kept = TA.to_stored(anomalies).select("batch_id", *[c for c in stored if c in anomalies.columns])
    kept = kept.drop("if_score", "mah_distance", "reason_code")
    return rounded(as_text(kept, *TIMES), "avg_speed_kmh", "fare_per_mile", digits=9)


@query(
    O.SCORED
    + """SELECT batch_id, trip_id FROM normals
    QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY trip_id) <= 50"""
)
def normal_samples(spark, d):
    """The first 50 normal trips of every batch, as the sink caps them."""
    normals, _ = P.results(spark, d)
    return TA.normal_sample(normals, ["trip_id"], by="batch_id").select("batch_id", "trip_id")


@query(
    O.SCORED
    + """SELECT trip_id, taxi_type, fare_amount, CAST(NULL AS DOUBLE) AS fare_per_mile,
    CAST(NULL AS VARCHAR) AS reason FROM normals"""
)
def evolved_schema(spark, d):
    """A table written before two columns existed, read under the current schema."""
    from pyspark.sql import types as T

    normals, _ = P.results(spark, d)
    old = normals.select("trip_id", "taxi_type", "fare_amount")
    fields = [T.StructField("trip_id", T.LongType()), *S.ANOMALOUS_TRIPS.fields]
    wanted = ["trip_id", "taxi_type", "fare_amount", "fare_per_mile", "reason"]
    return TA.evolve(old, T.StructType([f for f in fields if f.name in wanted]))


# --- Projections and scalar functions --------------------------------------------------------------


@query(O.TRIPS + f"SELECT trip_id, {text_sql(*TIMES)} FROM trips")
def renamed_datetimes(spark, d):
    trips = P.trips(spark, d)
    fleets = [SO.normalise_names(fleet_file(trips, f)).select("trip_id", *TIMES) for f in S.FLEETS]
    return as_text(SO.merge_fleets(*fleets), *TIMES)


@query(O.TRIPS + "SELECT trip_id, taxi_type FROM trips")
def fleet_tag(spark, d):
    trips = P.trips(spark, d)
    return SO.merge_fleets(*[SO.tag_fleet(fleet_file(trips, f), f).select("trip_id", "taxi_type") for f in S.FLEETS])


@query(
    O.TRIPS
    + f"""SELECT trip_id, coalesce(strftime(pickup_datetime, {SQL_TIME}), 'NaT') AS pickup_datetime,
    coalesce(strftime(CASE WHEN trip_id % 13 = 0 THEN NULL ELSE dropoff_datetime END, {SQL_TIME}), 'NaT') AS dropoff_datetime
    FROM trips"""
)
def datetime_texts(spark, d):
    gaps = P.trips(spark, d).withColumn(
        "dropoff_datetime", F.when(F.col("trip_id") % 13 != 0, F.col("dropoff_datetime"))
    )
    return SO.stringify_times(gaps.select("trip_id", *TIMES))


@query(O.TRIPS + "SELECT trip_id, coalesce(passenger_count, 0e0) AS passenger_count, trip_distance, fare_amount FROM trips")
def zero_filled_numbers(spark, d):
    return SO.zero_fill(P.trips(spark, d).select("trip_id", "passenger_count", "trip_distance", "fare_amount"))


@query(
    O.TRIPS
    + f"""SELECT trip_id, CASE WHEN trip_id % 13 = 0 THEN NULL ELSE strftime(pickup_datetime, {SQL_TIME}) END AS parsed
    FROM trips"""
)
def parsed_datetimes(spark, d):
    """Texts back to timestamps; 'NaT' gives null."""
    text = F.when(F.col("trip_id") % 13 == 0, F.lit("NaT")).otherwise(F.date_format("pickup_datetime", TIME))
    return as_text(P.trips(spark, d).select("trip_id", X.parse_time(text).alias("parsed")), "parsed")


@query(
    O.TRIPS
    + """SELECT trip_id, trip_duration_sec, CAST(trip_duration_sec AS DOUBLE) + (trip_id % 4) / 4e0 AS exact_duration
    FROM trips"""
)
def trip_durations(spark, d):
    """Whole seconds, and seconds with their fraction."""
    part = F.timestamp_add("MILLISECOND", (F.col("trip_id") % 4) * 250, F.col("dropoff_datetime"))
    return P.trips(spark, d).select(
        "trip_id",
        X.trip_duration(*TIMES).alias("trip_duration_sec"),
        X.trip_duration_exact("pickup_datetime", part).alias("exact_duration"),
    )


@query(O.TRIPS + "SELECT trip_id, pickup_hour FROM trips")
def pickup_hours(spark, d):
    return P.trips(spark, d).select("trip_id", X.pickup_hour("pickup_datetime").alias("pickup_hour"))


@query(O.FEATS + "SELECT trip_id, avg_speed_kmh FROM feats")
def average_speed(spark, d):
    return P.features(spark, d).select("trip_id", "avg_speed_kmh")


@query(O.FEATS + "SELECT trip_id, fare_per_mile FROM feats")
def fare_rate(spark, d):
    return P.features(spark, d).select("trip_id", "fare_per_mile")


def _batch_features(spark, d):
    return FE.batch_features(P.trips(spark, d))


@query(O.LABELS + f"SELECT trip_id, {O.rounded('avg_speed_kmh', 'fare_per_mile', digits=9)} FROM bfeats")
def batch_speed_and_rate(spark, d):
    kept = _batch_features(spark, d).select("trip_id", "avg_speed_kmh", "fare_per_mile")
    return rounded(kept, "avg_speed_kmh", "fare_per_mile", digits=9)


@query(O.FEATS + "SELECT trip_id, round(hour_sin, 6) + 0e0 AS hour_sin, round(hour_cos, 6) + 0e0 AS hour_cos FROM feats")
def cyclic_hour(spark, d):
    return rounded(P.features(spark, d).select("trip_id", "hour_sin", "hour_cos"), "hour_sin", "hour_cos")


@query(
    O.LABELS
    + """SELECT trip_id, round(log_distance, 6) AS log_distance, round(log_fare, 6) AS log_fare,
    round(ln(1e0 + greatest(0e0, fare_amount - 20e0)), 6) AS log_clamped FROM bfeats"""
)
def log_features(spark, d):
    df = _batch_features(spark, d)
    kept = df.select(
        "trip_id", "log_distance", "log_fare", X.log_feature(F.col("fare_amount") - 20.0, clamp=True).alias("log_clamped")
    )
    return rounded(kept, "log_distance", "log_fare", "log_clamped")


@query(O.FEATS + f"SELECT trip_id, {O.rounded('speed_x_duration', 'fare_distance_ratio', digits=9)} FROM feats")
def interaction_features(spark, d):
    kept = P.features(spark, d).select("trip_id", "speed_x_duration", "fare_distance_ratio")
    return rounded(kept, "speed_x_duration", "fare_distance_ratio", digits=9)


@query(O.FEATS + "SELECT is_rush_hour, is_night, pickup_hour, count(*) AS trips FROM feats GROUP BY ALL")
def hour_flags(spark, d):
    return P.features(spark, d).groupBy("is_rush_hour", "is_night", "pickup_hour").agg(F.count("*").alias("trips"))


@query(
    O.TRIPS
    + """SELECT trip_id, CAST(coalesce(passenger_count, 1) AS INT) AS passengers,
    CAST(trunc(fare_amount) AS INT) AS fare, 7 AS from_nan, CAST(CASE WHEN trip_id % 3 = 0 THEN trip_id ELSE 0 END AS INT) AS from_text
    FROM trips"""
)
def safe_integers(spark, d):
    text = F.when(F.col("trip_id") % 3 == 0, F.col("trip_id").cast("string")).otherwise(F.lit("n/a"))
    return P.trips(spark, d).select(
        "trip_id",
        X.safe_int("passenger_count", 1).alias("passengers"),
        X.safe_int("fare_amount").alias("fare"),
        X.safe_int(F.col("fare_amount") * F.lit(float("nan")), 7).alias("from_nan"),
        X.safe_int(text).alias("from_text"),
    )


@query(
    O.MATCHED + f"SELECT trip_id, strftime(k_minute, {SQL_TIME}) AS k_minute, k_distance, k_fare FROM pred"
)
def match_keys(spark, d):
    return as_text(MA.match_key(P.scored(spark, d)).select("trip_id", *MA.KEY), "k_minute")


@query(
    O.SCORED
    + """SELECT trip_id, is_anomaly AS y_pred, CASE WHEN is_anomaly = 1 THEN reason_code END AS shown
    FROM scored"""
)
def prediction_tags(spark, d):
    """Both result tables as one frame with constant predictions and typed null reasons."""
    normals, anomalies = P.results(spark, d)
    both = MA.all_scored(anomalies.select("trip_id", "reason", "reason_code"), normals.select("trip_id"))
    shown = F.when(F.col("reason").isNotNull(), F.col("reason_code"))
    return both.select("trip_id", "y_pred", shown.alias("shown"))


@query(O.SCORED + "SELECT trip_id, reason, reason_code FROM anomalies")
def reason_texts(spark, d):
    df = P.scored(spark, d).drop("reason", "reason_code").filter("is_anomaly = 1")
    return df.select("trip_id", rules.reason().alias("reason"), rules.reason_code().alias("reason_code"))


@query(O.SCORED + "SELECT CASE WHEN anomaly_score > 0.15e0 THEN '[HIGH]' ELSE '[MEDIUM]' END AS severity, count(*) AS trips FROM scored GROUP BY 1")
def severity_tags(spark, d):
    return P.scored(spark, d).groupBy(rules.severity("anomaly_score").alias("severity")).agg(F.count("*").alias("trips"))


@query(
    O.SCORED
    + """SELECT trip_id, CASE WHEN anomaly_score >= 0.8e0 THEN 'Strong' WHEN anomaly_score >= 0.6e0 THEN 'Moderate' ELSE 'Weak' END AS f1_grade,
    CASE WHEN anomaly_score >= 0.8e0 THEN 'EXCELLENT' WHEN anomaly_score >= 0.6e0 THEN 'GOOD' WHEN anomaly_score >= 0.4e0 THEN 'FAIR' ELSE 'POOR' END AS grade
    FROM scored"""
)
def grade_bands(spark, d):
    score = "anomaly_score"
    return P.scored(spark, d).select(
        "trip_id", grades.f1_grade(score).alias("f1_grade"), grades.generic_grade(score).alias("grade")
    )


# --- Filters -------------------------------------------------------------------------------------


@query(O.FEATS + "SELECT trip_id FROM valid")
def validity_filter(spark, d):
    return FE.valid_trips(FE.time_features(P.trips(spark, d))).select("trip_id")


@query(
    O.LABELS
    + "SELECT trip_id, trip_distance, fare_amount, CAST(trip_duration_sec AS DOUBLE) AS trip_duration_sec, pickup_hour, passenger_count, "
    + O.rounded("avg_speed_kmh", "fare_per_mile", digits=9)
    + " FROM bfeats WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in S.BASE_FEATURES)
)
def complete_rows(spark, d):
    rows = FE.drop_missing(_batch_features(spark, d), S.BASE_FEATURES).select("trip_id", *S.BASE_FEATURES)
    return rounded(rows, "avg_speed_kmh", "fare_per_mile", digits=9)


@query(O.TRIPS + "SELECT trip_id, taxi_type FROM trips WHERE passenger_count IS NOT NULL")
def rows_without_nulls(spark, d):
    return FE.drop_any_null(P.trips(spark, d)).select("trip_id", "taxi_type")


@query(O.FEATS + "SELECT count(*) AS raw, (SELECT count(*) FROM feats) AS clean FROM trips")
def guard_counts(spark, d):
    """Raw and clean rows of the guard in one pass."""
    flagged = FE.flagged_stream_features(P.trips(spark, d))
    return flagged.agg(F.count("*").alias("raw"), F.count_if(F.col("is_clean")).alias("clean"))


@query(O.SCORED + "SELECT is_anomaly, count(*) AS trips, min(trip_id) AS first_trip FROM scored GROUP BY 1")
def prediction_split(spark, d):
    parts = FE.split(P.scored(spark, d))
    return SO.merge_fleets(
        *[p.groupBy("is_anomaly").agg(F.count("*").alias("trips"), F.min("trip_id").alias("first_trip")) for p in parts]
    )


@query(O.TRIPS + "SELECT trip_id FROM trips WHERE passenger_count IS NOT NULL")
def non_null_column(spark, d):
    return FE.not_null(P.trips(spark, d), "passenger_count").select("trip_id")


@query(O.TRIPS + "SELECT taxi_type, count(*) AS trips FROM trips WHERE taxi_type = 'green' GROUP BY 1")
def fleet_filter(spark, d):
    return FE.for_fleet(P.trips(spark, d), "Green").groupBy("taxi_type").agg(F.count("*").alias("trips"))


# --- Joins and set operations ----------------------------------------------------------------------


@query(O.WHOLE_MATCHED + "SELECT trip_id, y_pred, is_anomaly, ai_anomaly_score, ai_reason FROM matched")
def label_matches(spark, d):
    return _matched(spark, d).select("trip_id", "y_pred", *MA.LABEL_COLUMNS)


@query(
    O.WHOLE_MATCHED
    + f"SELECT taxi_type, strftime(k_minute, {SQL_TIME}) AS k_minute, k_distance, k_fare, is_anomaly, ai_anomaly_score, ai_reason FROM truth"
)
def deduplicated_labels(spark, d):
    return as_text(MA.dedupe_labels(P.labels(spark, d), ["trip_id"]), "k_minute")


@query(
    O.SCORED
    + """SELECT f.taxi_type, coalesce(n.trips, 0) AS trips FROM (VALUES ('yellow'), ('green'), ('unseen')) f(taxi_type)
    LEFT JOIN (SELECT taxi_type, count(*) AS trips FROM scored GROUP BY 1) n USING (taxi_type)"""
)
def fleet_value_with_default(spark, d):
    """Every fleet's count; a name without rows gets the default."""
    counted = P.scored(spark, d).groupBy("taxi_type").agg(F.count("*").alias("trips"))
    names = DA.fleets(counted).union(spark.createDataFrame([("unseen",)], "taxi_type string"))
    return MA.fleet_lookup(counted, names, {"trips": 0})


@query(O.SCORED + "SELECT trip_id, is_anomaly AS y_pred, round(anomaly_score, 6) AS anomaly_score FROM scored")
def union_of_results(spark, d):
    normals, anomalies = P.results(spark, d)
    both = MA.all_scored(anomalies, normals).select("trip_id", "y_pred", "anomaly_score")
    return rounded(both, "anomaly_score")


@query(O.TRIPS + "SELECT taxi_type, count(*) AS trips, round(sum(CAST(round(fare_amount * 100) AS BIGINT)) / 100e0, 2) AS fares FROM trips GROUP BY 1")
def merged_fleets(spark, d):
    trips = P.trips(spark, d)
    merged = SO.merge_fleets(*[SO.project_source(fleet_file(trips, f), f) for f in S.FLEETS])
    hundredths = F.sum(F.round(F.col("fare_amount") * 100).cast("long")) / F.lit(100.0)
    return merged.groupBy("taxi_type").agg(F.count("*").alias("trips"), F.round(hundredths, 2).alias("fares"))


# --- Aggregations ----------------------------------------------------------------------------------


@query(O.SCORED + "SELECT taxi_type, count(*) AS total_normal, round(avg(fare_amount), 6) AS avg_fare FROM normals GROUP BY 1")
def normal_counts_by_fleet(spark, d):
    return rounded(DA.normal_by_fleet(P.results(spark, d)[0]), "avg_fare")


@query(O.SCORED + "SELECT taxi_type, count(*) AS total_anomalies FROM anomalies GROUP BY 1")
def anomaly_counts_by_fleet(spark, d):
    return DA.anomalies_by_fleet(P.results(spark, d)[1])


@query(
    O.SCORED
    + """SELECT reason_code, count(*) AS cnt, round(count(*) / CAST((SELECT count(*) FROM anomalies) AS DOUBLE), 6) AS share
    FROM anomalies GROUP BY 1"""
)
def reason_share(spark, d):
    return rounded(DI.reason_shares(P.results(spark, d)[1]), "share")


@query(
    O.METRICS
    + """SELECT CAST(sum(records_processed) AS BIGINT) AS records, round(sum(estimated_cost_usd), 9) AS cost_usd
    FROM (SELECT * FROM metrics ORDER BY inserted_at DESC, batch_id DESC LIMIT 50)"""
)
def recent_batch_totals(spark, d):
    return rounded(DA.recent_totals(P.metrics(spark, d)), "cost_usd", digits=9)


@query(
    O.SCORED
    + """SELECT taxi_type, round(count(*) FILTER (WHERE is_anomaly = 1) / CAST(count(*) AS DOUBLE), 6) AS anomaly_share
    FROM scored GROUP BY 1"""
)
def fleet_anomaly_share(spark, d):
    return rounded(DA.anomaly_share(*P.results(spark, d)), "anomaly_share")


@query(
    O.SCORED
    + """SELECT taxi_type, round(avg(fare_amount) FILTER (WHERE is_anomaly = 0), 2) AS avg_fare,
    round(count(*) FILTER (WHERE is_anomaly = 1) / CAST(count(*) AS DOUBLE) * 100, 1) AS anomaly_percent FROM scored GROUP BY 1"""
)
def fleet_kpis(spark, d):
    return DA.kpi_format(DA.fleet_summary(*P.results(spark, d)))


@query(
    O.METRICS
    + """, recent AS (SELECT * FROM metrics ORDER BY inserted_at DESC, batch_id DESC LIMIT 50)
    SELECT format('{:,}', CAST(round_even(max_by(throughput_eps, batch_id), 0) AS BIGINT)) AS throughput,
    format('{:,}', CAST(round_even(max_by(processing_time_ms, batch_id), 0) AS BIGINT)) || ' ms' AS latency,
    format('{:,}', CAST(sum(records_processed) AS BIGINT)) AS records, format('${:.4f}', sum(estimated_cost_usd)) AS cost FROM recent"""
)
def system_kpis(spark, d):
    return DA.system_kpis(P.metrics(spark, d))


def _matched(spark, d):
    pred = P.scored(spark, d).withColumn("y_pred", F.col("is_anomaly"))
    pred = pred.select("trip_id", "taxi_type", "pickup_datetime", "trip_distance", "fare_amount", "anomaly_score", "y_pred")
    return MA.match_labels(pred, MA.dedupe_labels(P.labels(spark, d), ["trip_id"]), ["trip_id"])


def _counts(spark, d, labels):
    pred = P.scored(spark, d).withColumn("y_pred", F.col("is_anomaly"))
    return MA.match_counts(pred, MA.dedupe_labels(labels(spark, d), ["trip_id"]))


def _report(spark, d, labels):
    return EV.ratios(EV.confusion(_counts(spark, d, labels)))


RATIO_SQL = O.rounded(*EV.RATIOS)


@query(O.WHOLE_REPORT + "SELECT taxi_type, matched, total, tp, tn, fp, fn FROM confusion JOIN totals USING (taxi_type)")
def confusion_counts(spark, d):
    return EV.confusion(_counts(spark, d, P.labels))


@query(O.WHOLE_REPORT + f"SELECT taxi_type, {RATIO_SQL} FROM report")
def accuracy_ratios(spark, d):
    return rounded(_report(spark, d, P.labels).select("taxi_type", *EV.RATIOS), *EV.RATIOS)


MACRO_SQL = """round(avg(f1), 6) AS f1, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
    round(avg(accuracy), 6) AS accuracy, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(tp) AS BIGINT) AS tp,
    CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn"""


@query(O.WHOLE_REPORT + f"SELECT {MACRO_SQL} FROM report")
def macro_averages(spark, d):
    return rounded(EV.macro_average(_report(spark, d, P.labels)), "f1", "precision", "recall", "accuracy")


@query(
    O.SCORED
    + """SELECT CASE is_anomaly WHEN 1 THEN 'anomaly' ELSE 'normal' END AS class, count(*) AS n,
    round(avg(anomaly_score), 6) AS mean, round(stddev_samp(anomaly_score), 6) AS std FROM scored GROUP BY 1"""
)
def class_score_moments(spark, d):
    return rounded(DI.score_moments(DI.both_classes(*P.results(spark, d))), "mean", "std")


@query(O.LABELS + f"SELECT {', '.join(f'round(median({c}), 6) AS {c}' for c in S.MODEL_FEATURES)} FROM bfeats")
def column_medians(spark, d):
    found = QU.medians(_batch_features(spark, d), S.MODEL_FEATURES)
    df = spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} double" for c in found))
    return rounded(df, *S.MODEL_FEATURES)


MINMAX_SQL = "({0} - min({0}) OVER ()) / (max({0}) OVER () - min({0}) OVER () + 0.000000001e0)"


@query(O.SCORED + f"SELECT trip_id, round({MINMAX_SQL.format('mah_distance')}, 6) AS unit FROM scored")
def min_max_scaled(spark, d):
    return rounded(NO.min_max(P.scored(spark, d), "mah_distance", "unit").select("trip_id", "unit"), "unit")


def _histogram_sql(column: str, bins: int, by: str | None = None) -> str:
    """Every bin of every group, empty ones with 0 rows."""
    key = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM rows_in) g CROSS JOIN " if by else ""
    using = f"({key}bin)"
    return f"""SELECT {key}CAST(bin AS INT) AS bin, round(mn + w * bin, 9) AS low, round(mn + w * (bin + 1), 9) AS high, coalesce(c.rows, 0) AS rows
    FROM {groups}range({bins}) b(bin) CROSS JOIN (SELECT min({column}) AS mn, (max({column}) - min({column})) / {bins}e0 AS w FROM rows_in) s
    LEFT JOIN (SELECT {key}least(floor(({column} - lo) / ((hi - lo) / {bins}e0)), {bins - 1})::BIGINT AS bin, count(*) AS rows
          FROM rows_in, (SELECT min({column}) AS lo, max({column}) AS hi FROM rows_in) GROUP BY ALL) c USING {using}"""


@query(O.SCORED + ", rows_in AS (SELECT * FROM normals) " + _histogram_sql("anomaly_score", 10))
def score_histogram(spark, d):
    return rounded(HI.histogram(P.results(spark, d)[0], "anomaly_score"), "low", "high", digits=9)


@query(O.WHOLE_MATCHED + ", rows_in AS (SELECT * FROM matched) " + _histogram_sql("anomaly_score", 40, "is_anomaly"))
def score_histogram_by_class(spark, d):
    matched, _ = stage(_matched(spark, d).select("anomaly_score", "is_anomaly"), "matched")
    return rounded(HI.histogram_by(matched, "anomaly_score", "is_anomaly"), "low", "high", digits=9)


@query(O.SCORED + "SELECT round(quantile_cont(mah_distance, 0.975e0), 6) AS threshold FROM scored")
def distance_threshold(spark, d):
    cut = QU.threshold(P.scored(spark, d), "mah_distance", S.DISTANCE_QUANTILE)
    return rounded(spark.createDataFrame([(cut,)], "threshold double"), "threshold")


@query(O.METRICS + "SELECT batch_id, records_processed, anomalies_detected, round(anomaly_rate, 6) AS anomaly_rate FROM metrics")
def batch_counts(spark, d):
    kept = P.metrics(spark, d).select("batch_id", "records_processed", "anomalies_detected", "anomaly_rate")
    return rounded(kept, "anomaly_rate")


@query(O.LABELS + "SELECT count(*) AS total, CAST(sum(is_anomaly) AS BIGINT) AS anomalies, round(avg(is_anomaly), 6) AS share FROM labels")
def labelling_totals(spark, d):
    return rounded(LA.label_totals(P.labels(spark, d)), "share")


# --- Sorts, limits, top-k --------------------------------------------------------------------------

METRIC_SQL = """batch_id, inserted_at, round(processing_time_ms, 6) AS processing_time_ms,
    round(throughput_eps, 6) AS throughput_eps, round(estimated_cost_usd, 9) AS estimated_cost_usd,
    records_processed, anomalies_detected, round(anomaly_rate, 6) AS anomaly_rate"""


@query(O.METRICS + f"SELECT {METRIC_SQL} FROM metrics ORDER BY inserted_at DESC, batch_id DESC LIMIT 50")
def recent_metric_rows(spark, d):
    df = rounded(DA.recent_metrics(P.metrics(spark, d)), "processing_time_ms", "throughput_eps", "anomaly_rate")
    return rounded(df, "estimated_cost_usd", digits=9)


@query(O.SCORED + "SELECT trip_id, batch_id, reason FROM anomalies ORDER BY batch_id DESC, trip_id DESC LIMIT 500")
def latest_anomalies(spark, d):
    return DA.latest(P.results(spark, d)[1], ["batch_id", "trip_id"]).select("trip_id", "batch_id", "reason")


@query(
    O.SCORED
    + f"""SELECT taxi_type, VendorID, {text_sql("pickup_datetime")}, trip_distance, fare_amount,
    round(avg_speed_kmh, 9) AS avg_speed_kmh, anomaly_score FROM normals ORDER BY batch_id DESC, trip_id DESC LIMIT 8"""
)
def live_feed(spark, d):
    feed = DA.live_feed(P.results(spark, d)[0], ["batch_id", "trip_id"])
    return rounded(as_text(feed, "pickup_datetime"), "avg_speed_kmh", digits=9)


@query(O.METRICS + "SELECT round(throughput_eps, 6) AS throughput_eps FROM metrics ORDER BY inserted_at DESC, batch_id DESC LIMIT 1")
def current_throughput(spark, d):
    return rounded(DA.current_value(P.metrics(spark, d), "throughput_eps"), "throughput_eps")


@query(
    O.METRICS
    + "SELECT batch_id, inserted_at, round(processing_time_ms, 6) AS processing_time_ms FROM metrics ORDER BY inserted_at DESC, batch_id DESC LIMIT 50"
)
def latency_series(spark, d):
    return rounded(DA.series(P.metrics(spark, d), "processing_time_ms"), "processing_time_ms")


@query(O.METRICS + "SELECT batch_id, records_processed FROM metrics ORDER BY batch_id")
def batches_in_order(spark, d):
    return DA.by_batch(P.metrics(spark, d)).select("batch_id", "records_processed")


@query(O.SCORED + "SELECT trip_id, anomaly_score FROM normals ORDER BY trip_id LIMIT 2000")
def capped_sample(spark, d):
    """The sampling cap of the diagnostics, with a fixed order."""
    return DI.sample_cap(P.results(spark, d)[0], 2000, ["trip_id"]).select("trip_id", "anomaly_score")


DETAIL_SQL = f"""SELECT {text_sql("pickup_datetime")}, trip_distance, fare_amount, anomaly_score, ai_anomaly_score,
    CASE y_pred WHEN 1 THEN 'Anomaly' ELSE 'Normal' END AS streaming_prediction,
    CASE is_anomaly WHEN 1 THEN 'Anomaly' ELSE 'Normal' END AS ground_truth,
    CASE WHEN y_pred = is_anomaly THEN 'Yes' ELSE 'No' END AS correct, ai_reason FROM"""


@query(O.WHOLE_MATCHED + f"{DETAIL_SQL} (SELECT * FROM matched ORDER BY trip_id LIMIT 100)")
def matched_detail(spark, d):
    return as_text(EV.detail_rows(_matched(spark, d), ["trip_id"]), "pickup_datetime")


@query(O.WHOLE_MATCHED + f"{DETAIL_SQL} matched")
def matched_detail_flags(spark, d):
    """Readable classes and agreement for every matched trip."""
    return as_text(EV.detail_flags(_matched(spark, d)).select(*EV.DETAIL_COLUMNS), "pickup_datetime")


@query(
    O.SCORED
    + """, imp AS (SELECT reason_code AS feature, CAST(count(*) AS DOUBLE) AS importance FROM anomalies GROUP BY 1)
    SELECT feature, importance, round(importance / ((SELECT max(importance) FROM imp) + 0.000000001e0), 6) AS relative FROM imp"""
)
def ranked_importances(spark, d):
    """Ranking by importance, here over counts per reason."""
    counted = P.results(spark, d)[1].groupBy(F.col("reason_code").alias("feature"))
    return rounded(DI.rank_features(counted.agg(F.count("*").cast("double").alias("importance"))), "relative")


@query(
    O.SCORED
    + "SELECT reason_code AS feature FROM anomalies GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1"
)
def top_importance(spark, d):
    counted = P.results(spark, d)[1].groupBy(F.col("reason_code").alias("feature"))
    return DI.top_feature(counted.agg(F.count("*").cast("double").alias("importance")))


# --- Dashboard projections -------------------------------------------------------------------------


@query(
    O.SCORED
    + f"""SELECT taxi_type, {text_sql("pickup_datetime")}, trip_distance, fare_amount, round(avg_speed_kmh, 9) AS avg_speed_kmh,
    anomaly_score, reason FROM anomalies ORDER BY batch_id DESC, trip_id DESC LIMIT 500"""
)
def anomaly_log(spark, d):
    log = DA.feed_columns(DA.latest(P.results(spark, d)[1], ["batch_id", "trip_id"]), "anomaly_log")
    return rounded(as_text(log, "pickup_datetime"), "avg_speed_kmh", digits=9)


@query(
    O.SCORED
    + """SELECT trip_distance, round(avg_speed_kmh, 9) AS avg_speed_kmh, taxi_type, fare_amount
    FROM normals ORDER BY batch_id DESC, trip_id DESC LIMIT 500"""
)
def speed_by_distance(spark, d):
    rows = DA.latest(P.results(spark, d)[0], ["batch_id", "trip_id"])
    return rounded(DA.feed_columns(rows, "speed_distance"), "avg_speed_kmh", digits=9)


@query(
    O.SCORED
    + "SELECT trip_duration_sec, fare_amount, taxi_type FROM normals ORDER BY batch_id DESC, trip_id DESC LIMIT 500"
)
def fare_by_duration(spark, d):
    return DA.feed_columns(DA.latest(P.results(spark, d)[0], ["batch_id", "trip_id"]), "fare_duration")


# --- Rules -----------------------------------------------------------------------------------------


@query(O.FEATS + f", coded AS (SELECT taxi_type, {O.STREAM_CODE} AS reason_code FROM feats) SELECT taxi_type, reason_code, count(*) AS trips FROM coded GROUP BY ALL")
def rule_counts(spark, d):
    """Valid trips per fleet and first broken rule."""
    df = P.features(spark, d).select("taxi_type", rules.reason_code().alias("reason_code"))
    return df.groupBy("taxi_type", "reason_code").agg(F.count("*").alias("trips"))


@query(O.SCORED + "SELECT trip_id, reason_code <> 'statistical' AS violates FROM scored")
def rule_violations(spark, d):
    return P.features(spark, d).select("trip_id", rules.violates().alias("violates"))


@query(O.SCORED + "SELECT CASE WHEN reason_code <> 'statistical' THEN 3e0 ELSE 1e0 END AS weight, count(*) AS trips FROM scored GROUP BY 1")
def training_weights(spark, d):
    return P.features(spark, d).groupBy(rules.training_weight().alias("weight")).agg(F.count("*").alias("trips"))


@query(O.LABELS + "SELECT trip_id, rule_code, replace(ai_reason, '[RULE_VIOLATION] ', '') AS text FROM labels WHERE rule_code IS NOT NULL")
def labelling_rules(spark, d):
    df = _batch_features(spark, d).select(
        "trip_id", rules.batch_reason_code().alias("rule_code"), rules.batch_reason().alias("text")
    )
    return df.filter("rule_code IS NOT NULL")


@query(O.LABELS + "SELECT trip_id, is_anomaly, ai_reason FROM labels")
def label_votes(spark, d):
    flag, text = rules.label_vote(F.col("trip_id") % 41 == 0)
    return _batch_features(spark, d).select("trip_id", flag.alias("is_anomaly"), text.alias("ai_reason"))


# --- Detection -------------------------------------------------------------------------------------

def _scaler_sql(column: str) -> str:
    spread = f"quantile_cont(CAST({column} AS DOUBLE), 0.75e0) - quantile_cont(CAST({column} AS DOUBLE), 0.25e0)"
    return f"""SELECT '{column}' AS feature, round(quantile_cont(CAST({column} AS DOUBLE), 0.5e0), 6) AS center,
    round(CASE WHEN {spread} = 0 THEN 1e0 ELSE {spread} END, 6) AS scale FROM feats"""


@query(O.FEATS + " UNION ALL ".join(_scaler_sql(c) for c in S.MODEL_FEATURES))
def scaler_parameters(spark, d):
    return rounded(SC.fit_scaler(P.features(spark, d), S.MODEL_FEATURES).frame(spark), "center", "scale")


@query(
    O.FEATS
    + f", params AS ({' UNION ALL '.join(_scaler_sql(c).replace('round(', '(').replace(', 6)', ')') for c in S.MODEL_FEATURES)})"
    + "SELECT trip_id, "
    + ", ".join(
        f"round(({c} - (SELECT center FROM params WHERE feature = '{c}')) / (SELECT scale FROM params WHERE feature = '{c}'), 6) + 0e0 AS {c}"
        for c in S.MODEL_FEATURES
    )
    + " FROM feats"
)
def scaled_features(spark, d):
    df = P.features(spark, d)
    scaled = SC.scale(df, SC.fit_scaler(df, S.MODEL_FEATURES)).select("trip_id", *S.MODEL_FEATURES)
    return rounded(scaled, *S.MODEL_FEATURES)


@query(
    O.LABELS
    + "SELECT trip_id, "
    + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM bfeats)), 6) + 0e0 AS {c}" for c in S.MODEL_FEATURES)
    + " FROM bfeats"
)
def imputed_medians(spark, d):
    filled = SC.impute_median(_batch_features(spark, d), S.MODEL_FEATURES).select("trip_id", *S.MODEL_FEATURES)
    return rounded(filled, *S.MODEL_FEATURES)


def _scaled(spark, d):
    df = P.features(spark, d).withColumn("_w", rules.training_weight())
    return SC.scale(df, SC.fit_scaler(df, S.MODEL_FEATURES))


@query()
def forest_training(spark, d):
    """Trees of the streaming forest: rows drawn, depth and nodes of each."""
    nodes = FO.fit_forest(_scaled(spark, d), S.MODEL_FEATURES, ["trip_id"], weight=F.col("_w"))
    return nodes.select("tree", "sample_rows", "depth", "nodes")


@query()
def forest_scoring(spark, d):
    """Decision value and flag of every valid trip under a forest trained on them."""
    df = _scaled(spark, d)
    nodes, _ = stage(FO.fit_forest(df, S.MODEL_FEATURES, ["trip_id"], weight=F.col("_w")), "forest")
    forest = FO.load_forest(nodes, S.MODEL_FEATURES)
    cut = FO.decision_cut(df.select(FO.forest_score(spark, forest).alias("s")), "s", S.CONTAMINATION_PRIOR)
    return FO.score_forest(df, FO.with_cut(forest, cut)).select("trip_id", "if_score", "if_flag")


@query()
def covariance_fit(spark, d):
    """Centre of the robust covariance and its distance threshold."""
    model = CO.fit_covariance(_scaled(spark, d))
    rows = [(c, m, model.threshold) for c, m in zip(model.columns, model.location)]
    return spark.createDataFrame(rows, "feature string, center double, threshold double")


# A given centre, and a precision whose terms are of like size: distance, fare, seconds, speed, rate, kilometres, ratio.
GIVEN_MEAN = [2.5, 9.0, 900.0, 16.0, 3.5, 4.0, 3.5]
_UNITS = [1.0, 0.25, 0.001953125, 0.0625, 0.5, 0.5, 0.5]
GIVEN_PRECISION = [[(1.0 if i == j else -0.125) * a * b for j, b in enumerate(_UNITS)] for i, a in enumerate(_UNITS)]
MAHALANOBIS_SQL = " + ".join(
    f"{GIVEN_PRECISION[i][j]!r}::DOUBLE * ({a} - {GIVEN_MEAN[i]}e0) * ({b} - {GIVEN_MEAN[j]}e0)"
    for i, a in enumerate(S.COVARIANCE_FEATURES)
    for j, b in enumerate(S.COVARIANCE_FEATURES)
)


@query(
    O.FEATS
    + f""", dist AS (SELECT trip_id, {MAHALANOBIS_SQL} AS mah_distance FROM feats)
    SELECT trip_id, round(mah_distance, 6) AS mah_distance, CAST(mah_distance > 50 AS INT) AS mcd_flag FROM dist"""
)
def mahalanobis_distance(spark, d):
    """Squared distance and flag for a given centre and precision."""
    model = CO.Covariance(list(S.COVARIANCE_FEATURES), GIVEN_MEAN, GIVEN_PRECISION, 50.0)
    scored = CO.score_covariance(P.features(spark, d), model).select("trip_id", "mah_distance", "mcd_flag")
    return rounded(scored, "mah_distance")


@query(
    O.SCORED
    + """SELECT trip_id, CAST(if_flag = 1 AND mcd_flag = 1 AS INT) AS strict, CAST(if_flag = 1 OR mcd_flag = 1 AS INT) AS either,
    if_flag AS forest_only FROM scored"""
)
def ensemble_votes(spark, d):
    names = dict(zip(EN.MODES, ("strict", "either", "forest_only")))
    return P.scored(spark, d).select("trip_id", *[EN.vote(mode).alias(name) for mode, name in names.items()])


@query(
    O.SCORED
    + f"SELECT trip_id, round(0.6e0 * {MINMAX_SQL.format('if_score')} + 0.4e0 * {MINMAX_SQL.format('mah_distance')}, 6) AS anomaly_score FROM scored"
)
def combined_scores(spark, d):
    return rounded(NO.combine_scores(P.scored(spark, d)).select("trip_id", "anomaly_score"), "anomaly_score")


@query(
    O.SCORED
    + """SELECT round(avg(if_flag), 9) AS rate, round(greatest(0.01e0, least(0.04e0, 0.8e0 * 0.03e0 + 0.2e0 * avg(if_flag))), 9) AS contamination
    FROM scored"""
)
def next_contamination(spark, d):
    return rounded(EN.adaptive_contamination(P.scored(spark, d)), "rate", "contamination", digits=9)


@query(O.SCORED + f"SELECT trip_id, round({MINMAX_SQL.format('if_score')}, 6) AS ai_anomaly_score FROM scored")
def global_score(spark, d):
    return rounded(NO.normalise_global(P.scored(spark, d)).select("trip_id", "ai_anomaly_score"), "ai_anomaly_score")


@query()
def offline_labelling(spark, d):
    """The labelling job over each fleet's file, with its full-size forest."""
    labelled = [LA.label_frame(fleet_file(P.trips(spark, d), f), f, key=["trip_id"])[0] for f in S.FLEETS]
    columns = "trip_id", "is_anomaly", "ai_anomaly_score", "ai_reason"
    return reduce(DataFrame.unionByName, [frame.select(*columns) for frame in labelled])


@query()
def ensemble_scoring(spark, d):
    """Both detectors trained on the valid trips, then their vote and scores for each trip."""
    df = P.features(spark, d)
    _, model = TR.train_ensemble(df, ["trip_id"], S.CONTAMINATION_PRIOR)
    scored = TR.score_ensemble(df, model)
    return scored.select("trip_id", "if_score", "mah_distance", "if_flag", "mcd_flag", "is_anomaly")


# --- Streaming -------------------------------------------------------------------------------------


@query(
    O.SCORED
    + """, twice AS (SELECT trip_id, batch_id, taxi_type FROM scored UNION ALL SELECT trip_id, batch_id, 'again' FROM scored)
    SELECT trip_id, taxi_type FROM twice ORDER BY batch_id DESC, trip_id DESC, taxi_type DESC LIMIT 10000"""
)
def training_buffer(spark, d):
    """The rows the rolling buffer keeps of two feeds of the same trips: the newest 10,000 in arrival order."""
    feed = P.scored(spark, d).select("trip_id", "batch_id", "taxi_type", F.col("trip_id").alias("arrival_pos"))
    both = feed.union(feed.withColumn("taxi_type", F.lit("again")))
    return ST.newest(both.withColumn("arrival_source", F.col("taxi_type")), S.BUFFER_ROWS).select("trip_id", "taxi_type")


# --- Diagnostics and evaluation --------------------------------------------------------------------

CLASS_SQL = """cls AS (SELECT count(*) FILTER (WHERE is_anomaly = 0) AS normal_n, count(*) FILTER (WHERE is_anomaly = 1) AS anomaly_n,
    avg(anomaly_score) FILTER (WHERE is_anomaly = 0) AS normal_mean, avg(anomaly_score) FILTER (WHERE is_anomaly = 1) AS anomaly_mean,
    stddev_samp(anomaly_score) FILTER (WHERE is_anomaly = 0) AS normal_std, stddev_samp(anomaly_score) FILTER (WHERE is_anomaly = 1) AS anomaly_std,
    max(anomaly_score) FILTER (WHERE is_anomaly = 0) - min(anomaly_score) FILTER (WHERE is_anomaly = 0) AS normal_range,
    max(anomaly_score) FILTER (WHERE is_anomaly = 1) - min(anomaly_score) FILTER (WHERE is_anomaly = 1) AS anomaly_range FROM scored)"""


@query(
    O.SCORED
    + f""", {CLASS_SQL}, d AS (SELECT *, abs(anomaly_mean - normal_mean) / (sqrt((normal_std ** 2 + anomaly_std ** 2) / 2) + 0.000000001e0) AS cohens_d FROM cls)
    SELECT normal_n, anomaly_n, {O.rounded("normal_mean", "anomaly_mean", "normal_std", "anomaly_std", "cohens_d")},
    CASE WHEN cohens_d >= 1.5e0 THEN 'EXCELLENT' WHEN cohens_d >= 0.8e0 THEN 'GOOD' WHEN cohens_d >= 0.5e0 THEN 'FAIR' ELSE 'POOR' END AS verdict FROM d"""
)
def score_separation(spark, d):
    df = DI.score_separation(*P.results(spark, d))
    return rounded(df, "normal_mean", "anomaly_mean", "normal_std", "anomaly_std", "cohens_d")


@query(
    O.METRICS
    + f""", s AS (SELECT count(*) AS batches, avg(anomaly_rate) AS mean_rate, stddev_samp(anomaly_rate) AS std_rate FROM metrics),
    v AS (SELECT *, std_rate / (mean_rate + 0.000000001e0) AS cv FROM s)
    SELECT batches, {O.rounded("mean_rate", "std_rate", "cv")},
    CASE WHEN cv < 0.3e0 THEN 'STABLE' WHEN cv < 0.6e0 THEN 'MODERATE' ELSE 'UNSTABLE' END AS verdict FROM v WHERE batches >= 2"""
)
def rate_stability(spark, d):
    return rounded(DI.rate_stability(P.metrics(spark, d)), "mean_rate", "std_rate", "cv")


@query(O.METRICS + "SELECT batch_id, round(anomaly_rate, 6) AS anomaly_rate, anomalies_detected, records_processed FROM metrics")
def rate_series(spark, d):
    return rounded(DI.rate_series(P.metrics(spark, d)), "anomaly_rate")


@query(
    O.SCORED
    + """, r AS (SELECT count(*) AS anomalies, count(DISTINCT reason_code) AS reasons,
      count(*) FILTER (WHERE reason_code = 'statistical') / CAST(count(*) AS DOUBLE) AS fallback_share FROM anomalies)
    SELECT anomalies, reasons, round(fallback_share, 6) AS fallback_share,
    CASE WHEN reasons >= 4 AND fallback_share < 0.85e0 THEN 'DIVERSE' WHEN reasons >= 2 THEN 'LIMITED' ELSE 'NARROW' END AS verdict FROM r"""
)
def reason_coverage(spark, d):
    return rounded(DI.reason_coverage(P.results(spark, d)[1]), "fallback_share")


@query()
def permutation_sensitivity(spark, d):
    """Change of the flag rate per shuffled feature over all anomalies and normals."""
    normals, anomalies = P.results(spark, d)
    given = P.features(spark, d).withColumn("_w", rules.training_weight())
    scaler = SC.fit_scaler(given, S.MODEL_FEATURES)
    df = SC.scale(given, scaler)
    nodes, _ = stage(FO.fit_forest(df, S.MODEL_FEATURES, ["trip_id"], weight=F.col("_w")), "forest")
    forest = FO.load_forest(nodes, S.MODEL_FEATURES)
    cut = FO.decision_cut(df.select(FO.forest_score(spark, forest).alias("s")), "s", S.CONTAMINATION_PRIOR)
    model = TR.Model(scaler, FO.with_cut(forest, cut), None, S.CONTAMINATION_PRIOR)
    return DI.permutation_sensitivity(normals, anomalies, model, ["trip_id"])


@query(
    O.SCORED
    + """, r AS (SELECT count(*) AS anomalies, count(*) FILTER (WHERE reason_code <> 'statistical') AS rule_breakers FROM anomalies)
    SELECT anomalies, rule_breakers, round(rule_breakers / CAST(anomalies AS DOUBLE), 6) AS overlap,
    CASE WHEN rule_breakers / CAST(anomalies AS DOUBLE) >= 0.4e0 THEN 'HIGH OVERLAP' WHEN rule_breakers / CAST(anomalies AS DOUBLE) >= 0.2e0 THEN 'PARTIAL' ELSE 'LOW OVERLAP' END AS verdict FROM r"""
)
def rule_overlap(spark, d):
    return rounded(DI.rule_overlap(P.results(spark, d)[1]), "overlap")


@query(
    O.SCORED
    + f""", {CLASS_SQL} SELECT {O.rounded("normal_range", "anomaly_range")}, round(anomaly_mean - normal_mean, 6) AS gap,
    CASE WHEN anomaly_mean - normal_mean > 0.05e0 THEN 'BIMODAL' WHEN anomaly_mean - normal_mean > 0.01e0 THEN 'SLIGHT GAP' ELSE 'NO GAP' END AS verdict FROM cls"""
)
def score_distribution(spark, d):
    return rounded(DI.score_distribution(*P.results(spark, d)), "normal_range", "anomaly_range", "gap")


@query(
    O.SCORED
    + """, span AS (SELECT is_anomaly, min(anomaly_score) AS mn, (max(anomaly_score) - min(anomaly_score)) / 10e0 AS w FROM scored GROUP BY 1)
    SELECT CASE is_anomaly WHEN 1 THEN 'anomaly' ELSE 'normal' END AS class, CAST(bin AS INT) AS bin,
    round(mn + w * bin, 9) AS low, round(mn + w * (bin + 1), 9) AS high, coalesce(c.rows, 0) AS rows
    FROM span CROSS JOIN range(10) b(bin)
    LEFT JOIN (SELECT is_anomaly, least(floor((anomaly_score - mn) / w), 9)::BIGINT AS bin, count(*) AS rows
          FROM scored JOIN span USING (is_anomaly) GROUP BY ALL) c USING (is_anomaly, bin)"""
)
def class_histograms(spark, d):
    return rounded(DI.class_histograms(*P.results(spark, d)), "low", "high", digits=9)


@query(O.REPORT + f"SELECT taxi_type, matched, total, tp, tn, fp, fn, {RATIO_SQL} FROM report WHERE matched >= 5")
def evaluation_report(spark, d):
    return rounded(EV.min_matches(_report(spark, d, P.partial_labels)), *EV.RATIOS)


@query(
    O.REPORT
    + f""", m AS (SELECT {MACRO_SQL} FROM report WHERE matched >= 5)
    SELECT *, CASE WHEN f1 >= 0.8e0 THEN 'Strong' WHEN f1 >= 0.6e0 THEN 'Moderate' ELSE 'Weak' END AS grade FROM m"""
)
def overall_accuracy(spark, d):
    return rounded(EV.overall(_report(spark, d, P.partial_labels)), "f1", "precision", "recall", "accuracy")


@query(
    O.REPORT
    + " UNION ALL ".join(
        f"SELECT taxi_type, '{c}' AS metric, round({c} * 100, 6) AS percent FROM report" for c in EV.RATIOS
    )
)
def accuracy_profile(spark, d):
    return rounded(EV.profile(_report(spark, d, P.partial_labels)), "percent")
