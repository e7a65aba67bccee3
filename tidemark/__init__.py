"""tidemark: keep keyed silver tables up to date from database change records, on Spark.

The public entry points live in the sub-packages:

* ``tidemark.sources``    file listing, change/snapshot readers, table readers
* ``tidemark.operators``  envelope flattening, normalisation, keyed merge, surrogate maps
* ``tidemark.functions``  column expressions (time shift/clamp, micros, surrogate keys)
* ``tidemark.sinks``      partitioned writes, merge into a stored table, partition-wise export
* ``tidemark.plans``      one-table and multi-table runs, run state, metrics
* ``tidemark.streaming``  the same merge driven by a file stream (``foreachBatch``)
"""

from tidemark.spec import TableSpec

__all__ = ["TableSpec"]
