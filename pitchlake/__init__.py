"""pitchlake — cricket commentary analytics as plain Spark DataFrame functions.

Layers:
  sources/    file feeds (batch and streaming), table layout, fixture views
  functions/  Column -> Column expressions (parsing, name resolution, clocks, rates)
  operators/  DataFrame -> DataFrame datasets (silver, gold, quality reports)
  streaming/  incremental runs (availableNow) with checkpoints
  plans/      registered queries and their SQL oracles
"""

__all__ = ["constants", "schemas", "session"]
