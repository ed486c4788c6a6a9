"""Forecast evaluation — one aggregate pass for the headline metrics plus the
demand-class breakdown, over a predictions table (no per-row data reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from minutewise.operators import metrics


def evaluate(predictions: DataFrame) -> dict[str, DataFrame]:
    return {
        "metrics": metrics.forecast_metrics(predictions),
        "by_demand_class": metrics.demand_class_mae(predictions),
        "loss": metrics.hurdle_loss(predictions),
    }
