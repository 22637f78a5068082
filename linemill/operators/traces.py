"""Loss-change allocation over parameter traces.

Input ``param_trace(step, param, idx, theta_before, theta_after, grad)``,
one row per parameter element and step. Element products are summed as
doubles, so small products count in full and infinite or undefined gradients
give infinite or undefined sums instead of failing; totals of different task
layouts differ by rounding only (about 1e-16 of the largest term)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lca_products(trace: DataFrame) -> DataFrame:
    """Per element: (theta_after - theta_before) x grad."""
    p = (F.col("theta_after") - F.col("theta_before")) * F.col("grad")
    return trace.select("step", "param", "idx", p.cast("double").alias("lca"))


def lca_step_sums(trace: DataFrame) -> DataFrame:
    """Per (step, param): sum of element products and element count."""
    return lca_products(trace).groupBy("step", "param").agg(
        F.sum("lca").alias("_sum"), F.count(F.lit(1)).alias("n_elements"))


def _empty(trace: DataFrame, *cols: str) -> DataFrame:
    return trace.sparkSession.createDataFrame(
        [], "step long, param string, " + ", ".join(f"{c} double" for c in cols))


def lca_step(trace: DataFrame, lca_steps: int) -> DataFrame:
    """Sum and mean of the allocation per parameter at logged steps
    (``step % lca_steps == 0``); empty when ``lca_steps <= 0``."""
    if lca_steps <= 0:
        return _empty(trace, "lca_sum", "lca_mean")
    s = lca_step_sums(trace.filter(F.col("step") % lca_steps == 0))
    return s.select("step", "param", F.col("_sum").alias("lca_sum"),
                    (F.col("_sum") / F.col("n_elements")).alias("lca_mean"))


def lca_log(trace: DataFrame, lca_steps: int, reset: bool = False) -> DataFrame:
    """A8 + W1 side by side, from one aggregation and one window: the four
    numbers the reference logs per parameter and logged step.

    As in the reference the running allocation is never reset (cumulative from
    the first step); ``reset=True`` restarts it in every interval. The window
    runs over per-step totals (one row per step and parameter), never over
    elements."""
    if lca_steps <= 0:
        return _empty(trace, "lca_sum", "lca_mean", "interval_sum", "interval_mean")
    s = lca_step_sums(trace)
    part = ["param"] + ([F.ceil(F.col("step") / lca_steps)] if reset else [])
    w = Window.partitionBy(*part).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    cum = s.withColumn("_cum", F.sum("_sum").over(w)).filter(F.col("step") % lca_steps == 0)
    isum = F.col("_cum") / F.lit(float(lca_steps))
    return cum.select("step", "param", F.col("_sum").alias("lca_sum"),
                      (F.col("_sum") / F.col("n_elements")).alias("lca_mean"),
                      isum.alias("interval_sum"), (isum / F.col("n_elements")).alias("interval_mean"))


def lca_interval(trace: DataFrame, lca_steps: int, reset: bool = False) -> DataFrame:
    """Running allocation divided by ``lca_steps`` at logged steps."""
    return lca_log(trace, lca_steps, reset).select("step", "param", "interval_sum", "interval_mean")
