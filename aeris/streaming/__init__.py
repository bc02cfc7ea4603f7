"""Structured Streaming form of the daily statistics."""

from aeris.streaming.daily import (
    daily_stats_stream,
    measurement_stream,
    run_daily_fact_stream,
    run_daily_stats_stream,
)
from aeris.streaming.ledger import run_ledger_stream

__all__ = ["daily_stats_stream", "measurement_stream", "run_daily_fact_stream", "run_daily_stats_stream", "run_ledger_stream"]
