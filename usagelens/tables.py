"""The five tables every query reads, whatever their source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class UsageTables:
    """Employee dimension plus the four fact tables."""

    employees: DataFrame
    api_requests: DataFrame
    user_prompts: DataFrame
    tool_events: DataFrame
    api_errors: DataFrame
    # First and last day with an API request (ISO text), where the source knows them
    # without a scan.
    days: tuple[str, str] | None = None

    def fact(self, name: str) -> DataFrame:
        return getattr(self, name)
