"""Column expressions: every helper returns a ``Column`` built from native
Spark functions (no Python UDF), so it stays inside whole-stage codegen."""

from aeris.functions.numeric import round_half_up, stable_round
from aeris.functions.time import day_text, local_timestamp, run_window

__all__ = ["day_text", "local_timestamp", "run_window", "round_half_up", "stable_round"]
