"""Votes over detector flags and the contamination policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk import schema as S

MODES = ["strict", "union", "if_only"]


def vote(mode: str = "strict", forest: str = "if_flag", distance: str = "mcd_flag") -> Column:
    """1 for an anomaly: both flags (strict), either (union), or the forest's alone."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    a, b = F.col(forest) == 1, F.col(distance) == 1
    return {"strict": a & b, "union": a | b, "if_only": a}[mode].cast("int")


def blend_contamination(rate: Column | float, prior: float = S.CONTAMINATION_PRIOR) -> Column:
    """Fixed prior mixed with the observed flag rate, within bounds."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    mixed = F.lit(S.PRIOR_SHARE * prior) + F.lit(S.OBSERVED_SHARE) * rate
    return F.greatest(F.lit(S.CONTAMINATION_FLOOR), F.least(F.lit(S.CONTAMINATION_CEILING), mixed))


def adaptive_contamination(df: DataFrame, flag: str = "if_flag", prior: float = S.CONTAMINATION_PRIOR) -> DataFrame:
    """One row: the flag rate of the previous forest on the frame and the contamination to train with."""
    rate = df.agg(F.avg(F.col(flag).cast("double")).alias("rate"))
    return rate.select("rate", blend_contamination(F.col("rate"), prior).alias("contamination"))
