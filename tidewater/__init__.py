"""tidewater: Spark-native data movement jobs.

Incremental table migration by high-water mark, JSON event ingest
(batch and Structured Streaming) and CSV/text folder consolidation,
written with the DataFrame / SQL / Structured Streaming APIs.
"""

__version__ = "0.1.0"
