"""sluice: a retail lakehouse and its model / code-review gates as Spark DataFrame jobs.

Subpackages: ``sources`` (table scans, mappings, sinks), ``operators`` (the transforms and
jobs), ``functions`` (column helpers, bucketed prefix scans), ``plans`` (registered queries
with their SQL oracles) and ``streaming`` (Structured Streaming jobs).
"""
