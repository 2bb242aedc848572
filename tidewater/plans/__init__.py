from tidewater.plans.combine import combine_folder
from tidewater.plans.ingest import IngestResult, decode_messages, ingest_batch
from tidewater.plans.migration import migrate_all, migrate_table

__all__ = ["combine_folder", "IngestResult", "decode_messages", "ingest_batch", "migrate_all",
           "migrate_table"]
