"""aeris: air-quality analytics as plain Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions, so Catalyst sees the whole plan (pushdown, pruning,
broadcast and aggregation strategy are its choice, not ours).

Sub-packages:

* ``aeris.sources``   - landed JSON pages, cell tables, warehouse tables
* ``aeris.functions`` - column expressions (time, rounding, text, geometry)
* ``aeris.operators`` - dimensions, bridges, facts, joins, profile, limits, geo
* ``aeris.plans``     - load policy (create / skip / idempotent append), the
  daily ETL as one function, export
* ``aeris.streaming`` - the daily statistics as a Structured Streaming job
"""

__version__ = "0.1.0"
