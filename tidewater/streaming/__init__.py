from tidewater.streaming.ingest_stream import (MESSAGE_SCHEMA, cross_batch_dedup, ingest_stream,
                                               read_message_stream)

__all__ = ["MESSAGE_SCHEMA", "cross_batch_dedup", "ingest_stream", "read_message_stream"]
