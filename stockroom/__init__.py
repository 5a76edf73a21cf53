"""stockroom: inventory event analytics on Spark DataFrames.

Layers (each a plain DataFrame-in / DataFrame-out function):

* ``functions``  column expressions (JSON extraction, casts, day arithmetic)
* ``operators``  filters, latest-per-key, spans/day expansion, joins, quality checks
* ``sources``    table loading, declared schemas, test fixtures
* ``sinks``      full refresh, views, merge-by-key, time-range replace
* ``plans``      the composed models (typed events -> spans -> daily stock)
* ``streaming``  raw landing stream and micro-batch upserts
"""

__version__ = "0.1.0"
