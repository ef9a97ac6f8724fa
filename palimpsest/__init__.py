"""palimpsest: parallel-text corpus preparation as Spark DataFrame operators.

Every operator takes and returns DataFrames; planning is left to Catalyst.
Sub-packages:

- ``functions``  column expressions (no Python UDFs) for text, keys, JSON fields
- ``sources``    readers for manifests, sidecars, listings, result JSONL, splits
- ``sinks``      writers (CSV, JSONL requests, conversations, splits, progress)
- ``operators``  joins, reports, ladders, splits, packing, streaks, SFT tables
- ``plans``      derived inputs over the driver tables and the query registry
- ``streaming``  incremental ingestion of batch results and the batch ledger
"""

__version__ = "0.1.0"
