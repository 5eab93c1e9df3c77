"""carestar — hospital analytics on Spark DataFrames.

Layers (each a plain DataFrame -> DataFrame function on built-in expressions):

* ``carestar.functions``  column expressions: coercion, bins, normalisation
* ``carestar.sources``    file readers (CSV / JSON / XML), incremental extract,
                          and the binding of the driver's TPC-H-like tables
* ``carestar.sinks``      idempotent reloads, exports, run log
* ``carestar.operators``  data quality, dimensions, facts, the analytics mart
* ``carestar.plans``      named KPIs, report aggregates, the measure layer
* ``carestar.streaming``  Structured Streaming ingest and sensor windows
"""

__version__ = "0.1.0"
