"""End-to-end plans: layer layout, sizing and the bronze-silver-gold run."""

from tierflow.plans.gold import GOLD_MODELS
from tierflow.plans.incremental import STATEFUL_MODELS, layer_checks_incremental, run_gold_incremental
from tierflow.plans.layers import Layers
from tierflow.plans.pipeline import (
    layer_checks,
    register_tables,
    run_bronze,
    run_gold,
    run_pipeline,
    run_silver,
    stream_silver,
    streamed_counts,
)
from tierflow.plans.sizing import sized_for

__all__ = [
    "GOLD_MODELS",
    "Layers",
    "STATEFUL_MODELS",
    "layer_checks",
    "layer_checks_incremental",
    "register_tables",
    "run_bronze",
    "run_gold",
    "run_gold_incremental",
    "run_pipeline",
    "run_silver",
    "sized_for",
    "stream_silver",
    "streamed_counts",
]
