"""Where the tables of a lake live."""

from __future__ import annotations

from dataclasses import dataclass

GOLD_TABLES = ("dim_customer", "dim_product", "fact_events", "session_summary")


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/events"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{name}"

    def state(self, name: str) -> str:
        """Mergeable per-date parts that incremental runs keep."""
        return f"{self.root}/state/{name}"

    def silver_changes(self, number: int) -> str:
        """Rows that a version of silver has in other form than the version before."""
        return self.state(f"silver_changes/{number:012d}")

    @property
    def id_dates(self) -> str:
        """Dates that native event ids were seen at."""
        return self.state("id_dates")

    @property
    def gold_progress(self) -> str:
        return self.state("gold_progress")

    @property
    def ingest_checkpoint(self) -> str:
        return f"{self.root}/state/ingest_checkpoint"

    @property
    def quality(self) -> str:
        return self.gold_table("data_quality_results")
