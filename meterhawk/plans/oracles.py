"""Building blocks of the reference SQL for the registered queries (DuckDB dialect)."""

from __future__ import annotations

_TRIPS = """
b AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 211 = 7 THEN 60e0 ELSE 0e0 END
           + CAST(floor(value * 100e0 / 15e0) AS DOUBLE) / 100e0 AS dist
  FROM events),
c AS (
  SELECT *, CAST(CASE WHEN event_id % 199 = 3 THEN -30
                      WHEN event_id % 97 = 5 THEN 61 + event_id % 40
                      WHEN event_id % 83 = 2 THEN 7300 + event_id % 900
                      ELSE CAST(120e0 + floor(dist * 150e0) AS BIGINT) + (event_id * 7919) % 600
                 END AS BIGINT) AS dur
  FROM b),
trips AS (
  SELECT event_id AS trip_id,
         CASE WHEN event_id % 10 < 8 THEN 'yellow' ELSE 'green' END AS taxi_type,
         user_id % 2 + 1 AS VendorID,
         date_trunc('second', ts) AS pickup_datetime,
         date_trunc('second', ts) + to_seconds(dur) AS dropoff_datetime,
         dur AS trip_duration_sec,
         CAST(hour(ts) AS INT) AS pickup_hour,
         CAST(CASE WHEN event_id % 53 = 0 THEN 0 WHEN event_id % 59 = 0 THEN NULL
                   ELSE 1 + event_id % 6 END AS DOUBLE) AS passenger_count,
         dist AS trip_distance,
         CASE WHEN event_id % 73 = 1 THEN 1e0
              WHEN event_id % 211 = 7 THEN 20e0
              WHEN event_id % 61 = 4 THEN CAST(floor(2400e0 + 2000e0 * dist) AS DOUBLE) / 100e0
              WHEN event_id % 67 = 9 THEN CAST(floor(100e0 + 1200e0 * dist) AS DOUBLE) / 100e0
              ELSE CAST(floor(300e0 + 250e0 * dist) AS DOUBLE) / 100e0 END AS fare_amount
  FROM c)"""

_CLEAN = """
valid AS (
  SELECT * FROM trips
  WHERE trip_duration_sec > 60 AND trip_distance > 0.1e0 AND fare_amount > 0
    AND passenger_count >= 1 AND passenger_count <= 9),
rated AS (
  SELECT *, trip_distance * 1.60934e0 / (trip_duration_sec / 3600e0) AS avg_speed_kmh,
         fare_amount / trip_distance AS fare_per_mile
  FROM valid),
feats AS (
  SELECT *, sin(2e0 * pi() * pickup_hour / 24e0) AS hour_sin, cos(2e0 * pi() * pickup_hour / 24e0) AS hour_cos,
         avg_speed_kmh * trip_duration_sec / 3600e0 AS speed_x_duration,
         ln(1e0 + trip_distance) AS log_distance, ln(1e0 + fare_amount) AS log_fare,
         CAST(pickup_hour IN (7, 8, 9, 17, 18, 19) AS INT) AS is_rush_hour,
         CAST(pickup_hour IN (0, 1, 2, 3, 4, 5) AS INT) AS is_night,
         fare_amount / (trip_distance + 0.001e0) AS fare_distance_ratio
  FROM rated)"""

# First streaming rule a trip breaks.
STREAM_CODE = """CASE
  WHEN avg_speed_kmh > 140 THEN 'speed'
  WHEN fare_per_mile > 15 THEN 'rate'
  WHEN trip_duration_sec < 120 AND fare_amount > 50 THEN 'short_high_fare'
  WHEN fare_amount < 2.5e0 AND trip_distance > 0.5e0 THEN 'low_fare'
  WHEN trip_duration_sec > 7200 AND trip_distance < 5 THEN 'long_short_distance'
  WHEN passenger_count = 0 THEN 'zero_passengers'
  WHEN is_night = 1 AND avg_speed_kmh > 100 THEN 'night_speed'
  WHEN fare_amount > 150 THEN 'extreme_fare'
  WHEN trip_distance > 50 AND fare_per_mile < 1 THEN 'long_low_rate'
  ELSE 'statistical' END"""

STREAM_REASON = f"""CASE WHEN anomaly_score > 0.15e0 THEN '[HIGH] ' ELSE '[MEDIUM] ' END || CASE {STREAM_CODE}
  WHEN 'speed' THEN format('Unrealistic Speed (>{{:.0f}} km/h)', avg_speed_kmh)
  WHEN 'rate' THEN format('Extremely High Fare per Mile (${{:.1f}}/mi)', fare_per_mile)
  WHEN 'short_high_fare' THEN format('Short Trip, High Fare (${{:.0f}} in {{:.0f}}min)', fare_amount, trip_duration_sec / 60e0)
  WHEN 'low_fare' THEN format('Suspiciously Low Fare (${{:.2f}} for {{:.1f}}mi)', fare_amount, trip_distance)
  WHEN 'long_short_distance' THEN format('Long Duration, Short Distance ({{:.1f}}h / {{:.1f}}mi)', trip_duration_sec / 3600e0, trip_distance)
  WHEN 'zero_passengers' THEN 'Zero Passengers Reported'
  WHEN 'night_speed' THEN format('Night-time Speeding ({{:.0f}} km/h)', avg_speed_kmh)
  WHEN 'extreme_fare' THEN format('Extreme Fare Amount (${{:.0f}})', fare_amount)
  WHEN 'long_low_rate' THEN 'Very Long Trip, Suspiciously Low Rate'
  ELSE 'Statistical Outlier (IsolationForest)' END"""

_SCORED = f"""
coded AS (SELECT *, {STREAM_CODE} AS reason_code FROM feats),
scored AS (
  SELECT *, CAST(floor(least(fare_per_mile, 100e0) * 100e0) AS DOUBLE) / 10000e0 AS anomaly_score,
         CAST(floor(least(fare_per_mile, 100e0) * 100e0) AS DOUBLE) / 10000e0 - 0.0625e0 AS if_score,
         CAST(floor(avg_speed_kmh * 8e0) AS DOUBLE) / 8e0 AS mah_distance,
         CAST(trip_id % 7 = 0 AS INT) AS if_flag, CAST(trip_id % 5 = 0 AS INT) AS mcd_flag,
         CAST(reason_code <> 'statistical' OR trip_id % 29 = 0 AS INT) AS is_anomaly,
         trip_id // 100 AS batch_id
  FROM coded),
normals AS (SELECT * FROM scored WHERE is_anomaly = 0),
anomalies AS (SELECT *, {STREAM_REASON} AS reason FROM scored WHERE is_anomaly = 1)"""

_METRICS = """
counted AS (
  SELECT t.trip_id // 100 AS batch_id, count(*) AS records_processed, count(s.trip_id) AS clean,
         count(*) FILTER (WHERE s.is_anomaly = 1) AS anomalies_detected
  FROM trips t LEFT JOIN scored s USING (trip_id) GROUP BY 1),
timed AS (
  SELECT *, 20e0 + CAST(batch_id * 37 % 11 AS DOUBLE) + records_processed / 64e0 AS processing_time_ms
  FROM counted),
metrics AS (
  SELECT batch_id,
         strftime(make_timestamp((1700000000 + batch_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS inserted_at,
         records_processed, anomalies_detected,
         CAST(anomalies_detected AS DOUBLE) / greatest(clean, 1) AS anomaly_rate,
         processing_time_ms, records_processed / (processing_time_ms / 1000e0) AS throughput_eps,
         processing_time_ms * 0.000016e0 AS estimated_cost_usd
  FROM timed)"""

_BATCH = """
brated AS (
  SELECT *, trip_distance * 1.60934e0 / ((trip_duration_sec + 0.00001e0) / 3600e0) AS avg_speed_kmh,
         fare_amount / (trip_distance + 0.00001e0) AS fare_per_mile,
         CAST(pickup_hour IN (0, 1, 2, 3, 4, 5) AS INT) AS is_night,
         CAST(pickup_hour IN (7, 8, 9, 17, 18, 19) AS INT) AS is_rush_hour
  FROM trips),
bfeats AS (
  SELECT *, sin(2e0 * pi() * pickup_hour / 24e0) AS hour_sin, cos(2e0 * pi() * pickup_hour / 24e0) AS hour_cos,
         avg_speed_kmh * trip_duration_sec / 3600e0 AS speed_x_duration,
         ln(1e0 + greatest(0e0, trip_distance)) AS log_distance, ln(1e0 + greatest(0e0, fare_amount)) AS log_fare,
         fare_amount / (trip_distance + 0.001e0) AS fare_distance_ratio
  FROM brated),
bcoded AS (
  SELECT *, CASE
    WHEN trip_duration_sec IS NULL OR trip_duration_sec < 0 THEN 'bad_time'
    WHEN avg_speed_kmh > 150 THEN 'speed'
    WHEN fare_per_mile > 20 AND trip_distance > 0.5e0 THEN 'rate'
    WHEN trip_duration_sec < 60 AND fare_amount > 30 THEN 'short_high_fare'
    WHEN fare_amount < 2.5e0 AND trip_distance > 1 THEN 'low_fare'
    WHEN trip_duration_sec > 7200 AND trip_distance < 2 THEN 'long_short_distance'
    WHEN passenger_count = 0 THEN 'zero_passengers'
    WHEN is_night = 1 AND avg_speed_kmh > 120 THEN 'night_speed'
    WHEN fare_amount > 250 THEN 'extreme_fare'
    WHEN trip_distance > 60 AND fare_per_mile < 1 THEN 'long_low_rate' END AS rule_code
  FROM bfeats),
labels AS (
  SELECT *, CAST(rule_code IS NOT NULL OR trip_id % 41 = 0 AS INT) AS is_anomaly,
         (trip_id % 100) / 100e0 AS ai_anomaly_score,
         CASE WHEN rule_code IS NOT NULL THEN '[RULE_VIOLATION] ' || CASE rule_code
           WHEN 'bad_time' THEN 'Negative or missing time'
           WHEN 'speed' THEN format('Unrealistic Speed ({:.0f} km/h)', avg_speed_kmh)
           WHEN 'rate' THEN format('Extremely High Rate (${:.1f}/mi)', fare_per_mile)
           WHEN 'short_high_fare' THEN format('Short Trip, High Fare (${:.0f} in {:.0f}s)', fare_amount, trip_duration_sec + 0e0)
           WHEN 'low_fare' THEN format('Suspiciously Low Fare (${:.2f} for {:.1f}mi)', fare_amount, trip_distance)
           WHEN 'long_short_distance' THEN format('Long Duration, Short Distance ({:.1f}h / {:.1f}mi)', trip_duration_sec / 3600e0, trip_distance)
           WHEN 'zero_passengers' THEN 'Zero Passengers'
           WHEN 'night_speed' THEN format('Night-time Speeding ({:.0f} km/h)', avg_speed_kmh)
           WHEN 'extreme_fare' THEN format('Extreme Fare Amount (${:.0f})', fare_amount)
           ELSE 'Very Long Trip, Suspiciously Low Rate' END
         WHEN trip_id % 41 = 0 THEN '[AI_OUTLIER] Complex Statistical Anomaly' END AS ai_reason
  FROM bcoded)"""

_KEYS = """date_trunc('minute', pickup_datetime) AS k_minute, round_even(trip_distance * 100e0, 0) / 100e0 AS k_distance,
         round_even(fare_amount * 100e0, 0) / 100e0 AS k_fare"""


def _match_sql(labels: str) -> str:
    return f"""
pred AS (
  SELECT trip_id, taxi_type, pickup_datetime, trip_distance, fare_amount, anomaly_score, is_anomaly AS y_pred, {_KEYS}
  FROM scored),
keyed AS (SELECT trip_id, taxi_type, is_anomaly, ai_anomaly_score, ai_reason, {_KEYS} FROM {labels}),
truth AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY taxi_type, k_minute, k_distance, k_fare ORDER BY trip_id) = 1),
matched AS (
  SELECT p.*, t.is_anomaly, t.ai_anomaly_score, t.ai_reason
  FROM pred p JOIN truth t ON p.taxi_type = t.taxi_type AND p.k_minute IS NOT DISTINCT FROM t.k_minute
    AND p.k_distance IS NOT DISTINCT FROM t.k_distance AND p.k_fare IS NOT DISTINCT FROM t.k_fare)"""


_MATCHED = _match_sql("labels WHERE trip_id % 13 <> 5")
_WHOLE_MATCHED = _match_sql("labels")

_REPORT = """
totals AS (SELECT taxi_type, count(*) AS total FROM pred GROUP BY 1),
confusion AS (
  SELECT taxi_type, count(*) AS matched,
         count(*) FILTER (WHERE y_pred = 1 AND is_anomaly = 1) AS tp,
         count(*) FILTER (WHERE y_pred = 0 AND is_anomaly = 0) AS tn,
         count(*) FILTER (WHERE y_pred = 1 AND is_anomaly = 0) AS fp,
         count(*) FILTER (WHERE y_pred = 0 AND is_anomaly = 1) AS fn
  FROM matched GROUP BY 1),
pr AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0e0 END AS precision,
         CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0e0 END AS recall
  FROM confusion JOIN totals USING (taxi_type)),
report AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2e0 * precision * recall / (precision + recall) ELSE 0e0 END AS f1,
         CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
         CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE 0e0 END AS specificity
  FROM pr)"""


def _with(*parts: str) -> str:
    return "WITH" + ",".join(parts) + "\n"


TRIPS = _with(_TRIPS)
FEATS = _with(_TRIPS, _CLEAN)
SCORED = _with(_TRIPS, _CLEAN, _SCORED)
METRICS = _with(_TRIPS, _CLEAN, _SCORED, _METRICS)
LABELS = _with(_TRIPS, _BATCH)
MATCHED = _with(_TRIPS, _CLEAN, _SCORED, _BATCH, _MATCHED)
REPORT = _with(_TRIPS, _CLEAN, _SCORED, _BATCH, _MATCHED, _REPORT)
WHOLE_MATCHED = _with(_TRIPS, _CLEAN, _SCORED, _BATCH, _WHOLE_MATCHED)
WHOLE_REPORT = _with(_TRIPS, _CLEAN, _SCORED, _BATCH, _WHOLE_MATCHED, _REPORT)


def rounded(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
