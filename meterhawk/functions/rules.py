"""Business rules as data: each rule set is an ordered table compiled into one CASE expression."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterhawk import schema as S


class Rule(NamedTuple):
    """``test`` is SQL over the operands below; ``text`` lists words and (number, decimals) pairs."""

    code: str
    test: str
    text: list


# --- Fixed values: rule thresholds and the wording of reasons, in order of precedence. ------------

STREAM_RULES = [
    Rule("speed", "{speed} > 140", ["Unrealistic Speed (>", ("{speed}", 0), " km/h)"]),
    Rule("rate", "{rate} > 15", ["Extremely High Fare per Mile ($", ("{rate}", 1), "/mi)"]),
    Rule(
        "short_high_fare",
        "{duration} < 120 AND {fare} > 50",
        ["Short Trip, High Fare ($", ("{fare}", 0), " in ", ("{duration} / 60", 0), "min)"],
    ),
    Rule(
        "low_fare",
        "{fare} < 2.5D AND {distance} > 0.5D",
        ["Suspiciously Low Fare ($", ("{fare}", 2), " for ", ("{distance}", 1), "mi)"],
    ),
    Rule(
        "long_short_distance",
        "{duration} > 7200 AND {distance} < 5",
        ["Long Duration, Short Distance (", ("{duration} / 3600", 1), "h / ", ("{distance}", 1), "mi)"],
    ),
    Rule("zero_passengers", "{seats} = 0", ["Zero Passengers Reported"]),
    Rule("night_speed", "{night} AND {speed} > 100", ["Night-time Speeding (", ("{speed}", 0), " km/h)"]),
    Rule("extreme_fare", "{fare} > 150", ["Extreme Fare Amount ($", ("{fare}", 0), ")"]),
    Rule("long_low_rate", "{distance} > 50 AND {rate} < 1", ["Very Long Trip, Suspiciously Low Rate"]),
]
STREAM_FALLBACK = Rule("statistical", "true", ["Statistical Outlier (IsolationForest)"])

BATCH_RULES = [
    Rule("bad_time", "{duration} IS NULL OR {duration} < 0", ["Negative or missing time"]),
    Rule("speed", "{speed} > 150", ["Unrealistic Speed (", ("{speed}", 0), " km/h)"]),
    Rule("rate", "{rate} > 20 AND {distance} > 0.5D", ["Extremely High Rate ($", ("{rate}", 1), "/mi)"]),
    Rule(
        "short_high_fare",
        "{duration} < 60 AND {fare} > 30",
        ["Short Trip, High Fare ($", ("{fare}", 0), " in ", ("{duration}", 0), "s)"],
    ),
    Rule(
        "low_fare",
        "{fare} < 2.5D AND {distance} > 1",
        ["Suspiciously Low Fare ($", ("{fare}", 2), " for ", ("{distance}", 1), "mi)"],
    ),
    Rule(
        "long_short_distance",
        "{duration} > 7200 AND {distance} < 2",
        ["Long Duration, Short Distance (", ("{duration} / 3600", 1), "h / ", ("{distance}", 1), "mi)"],
    ),
    Rule("zero_passengers", "{passengers} = 0", ["Zero Passengers"]),
    Rule("night_speed", "{night} AND {speed} > 120", ["Night-time Speeding (", ("{speed}", 0), " km/h)"]),
    Rule("extreme_fare", "{fare} > 250", ["Extreme Fare Amount ($", ("{fare}", 0), ")"]),
    Rule("long_low_rate", "{distance} > 60 AND {rate} < 1", ["Very Long Trip, Suspiciously Low Rate"]),
]

SEVERITY_HIGH = "[HIGH]"
SEVERITY_MEDIUM = "[MEDIUM]"
LABEL_RULE_PREFIX = "[RULE_VIOLATION] "
LABEL_MODEL_TEXT = "[AI_OUTLIER] Complex Statistical Anomaly"

# --------------------------------------------------------------------------------------------------


def _number(column: str) -> str:
    """NaN sorts above every number in Spark; as null it fails every test."""
    return f"nanvl(CAST({column} AS DOUBLE), NULL)"


OPERANDS = {
    "speed": _number("avg_speed_kmh"),
    "rate": _number("fare_per_mile"),
    "duration": _number("trip_duration_sec"),
    "fare": _number("fare_amount"),
    "distance": _number("trip_distance"),
    "passengers": _number("passenger_count"),
    "seats": f"coalesce(TRY_CAST({_number('passenger_count')} AS INT), 0)",
    "night": "is_night = 1",
}


def _text(rule: Rule) -> str:
    def part(p) -> str:
        if isinstance(p, str):
            return f"'{p}'"
        number, places = p
        return f"format_number({number.format(**OPERANDS)}, '{'0.' + '0' * places if places else '0'}')"

    return f"concat({', '.join(map(part, rule.text))})"


def _first_match(rules: list[Rule], value) -> Column:
    cases = [f"WHEN {rule.test.format(**OPERANDS)} THEN {value(rule)}" for rule in rules]
    return F.expr(f"CASE {' '.join(cases)} END")


def _code(rule: Rule) -> str:
    return f"'{rule.code}'"


def severity(score: Column | str) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score > S.HIGH_SEVERITY_SCORE, SEVERITY_HIGH).otherwise(SEVERITY_MEDIUM)


def reason_code() -> Column:
    """Code of the first streaming rule a trip breaks, or the statistical fallback."""
    return _first_match([*STREAM_RULES, STREAM_FALLBACK], _code)


def reason(score: Column | str = "anomaly_score") -> Column:
    """Severity tag and wording of the first streaming rule a trip breaks."""
    return F.concat(severity(score), F.lit(" "), _first_match([*STREAM_RULES, STREAM_FALLBACK], _text))


def violates() -> Column:
    """True when any streaming rule holds."""
    tests = " OR ".join(f"({rule.test.format(**OPERANDS)})" for rule in STREAM_RULES)
    return F.expr(f"coalesce({tests}, false)")


def training_weight() -> Column:
    return F.when(violates(), F.lit(S.RULE_BREAKER_WEIGHT)).otherwise(F.lit(1.0))


def batch_reason_code() -> Column:
    """Code of the first labelling rule a trip breaks, or null."""
    return _first_match(BATCH_RULES, _code)


def batch_reason() -> Column:
    """Wording of the first labelling rule a trip breaks, or null."""
    return _first_match(BATCH_RULES, _text)


def label_vote(outlier: Column | str) -> tuple[Column, Column]:
    """(is_anomaly, ai_reason): a broken rule decides first, the model's flag second."""
    outlier = F.col(outlier) if isinstance(outlier, str) else outlier
    flag = F.when(batch_reason_code().isNotNull() | outlier, F.lit(1)).otherwise(F.lit(0))
    text = F.coalesce(
        F.concat(F.lit(LABEL_RULE_PREFIX), batch_reason()), F.when(outlier, F.lit(LABEL_MODEL_TEXT))
    )
    return flag, text
