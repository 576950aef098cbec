"""Silver to the gold tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import models, sessions
from tidemark.plans.session import require_utc
from tidemark.plans.silver import gathered
from tidemark.plans.together import together
from tidemark.sources.scratch import staging_folder, stored
from tidemark.sources.tables import read_table, write_table


def fact_rows(silver: DataFrame, index: DataFrame, gap_seconds: int) -> DataFrame:
    """Facts of the given silver rows, whose cells are all in the index, gathered by date, to be written as they are.

    Ids of events and sessions, most of a row, are made from the other columns where the rows are written.
    """
    sold = models.with_revenue(silver)
    numbered = sessions.attach_numbers(sold, index, gap_seconds)
    return models.fact_events(sessions.name_sessions(gathered(numbered)))


def run_gold(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    session_gap_minutes: int = 30,
    skip_corrupt: bool = False,
    mode: str = "overwrite",
) -> None:
    """Make the four gold tables from all of silver; ``append`` adds the rows to those that are there.

    Only the facts move whole events between tasks. The session index is staged because two
    tables are built from it; the dimensions read just the columns they aggregate.
    """
    require_utc(spark)
    gap_seconds = sessions.gap_from_minutes(session_gap_minutes)
    silver = read_table(spark, silver_dir, skip_corrupt=skip_corrupt)

    def write(name: str, rows: DataFrame, gather: bool = True) -> Callable[[], int]:
        return lambda: write_table(rows, f"{gold_dir}/{name}", mode, gather)

    with staging_folder(spark, "session_cells") as at, staging_folder(spark, "session_index") as folder:
        # Cells are read twice, to number them by block and the blocks by key.
        cells, *_ = together(
            spark,
            lambda: stored(sessions.session_cells(silver, gap_seconds), at),
            write("dim_customer", models.dim_customer(silver)),
            write("dim_product", models.dim_product(silver)),
        )
        index = stored(sessions.number_sessions(cells, gap_seconds), folder)
        together(
            spark,
            write("fact_events", fact_rows(silver, index, gap_seconds), gather=False),
            write("session_summary", sessions.summarize_sessions(silver, index, gap_seconds)),
        )
