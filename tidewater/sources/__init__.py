from tidewater.sources.files import (export_csv, export_csv_split, export_text, read_csv_folder_raw,
                                     read_csv_folder_typed, read_text_lines, read_text_whole)
from tidewater.sources.messages import (bounded_batch, kafka_options, messages_from_events,
                                        read_messages)
from tidewater.sources.tables import (chunk_stats, connection_options, extract, jdbc_options,
                                      jdbc_range_options, read_table)

__all__ = ["export_csv", "export_csv_split", "export_text", "read_csv_folder_raw",
           "read_csv_folder_typed", "read_text_lines", "read_text_whole", "bounded_batch",
           "kafka_options", "messages_from_events", "read_messages", "chunk_stats", "connection_options", "extract",
           "jdbc_options", "jdbc_range_options", "read_table"]
