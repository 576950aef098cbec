"""The jobs: raw files to bronze, bronze to silver, silver to gold, and the incremental run."""

from tidemark.plans.bronze import run_bronze
from tidemark.plans.gold import run_gold
from tidemark.plans.incremental import run_incremental
from tidemark.plans.quality import run_quality
from tidemark.plans.silver import run_silver, silver_events

__all__ = [
    "run_bronze",
    "run_gold",
    "run_incremental",
    "run_quality",
    "run_silver",
    "silver_events",
]
