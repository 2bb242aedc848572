from tidewater.operators.dedup import keep_first, keep_last
from tidewater.operators.enrich import (enrich_left, enrich_stats, load_lookup,
                                        lookup_fits_broadcast, prepare_lookup)
from tidewater.operators.marks import batch_max, commit_gate, fold_mark
from tidewater.operators.rename import rename_columns, select_mapped
from tidewater.operators.upsert import affected_rows, insert_only, insert_only_stats, upsert
from tidewater.operators.validate import reject_reason, validate_messages, validation_stats

__all__ = ["keep_first", "keep_last", "enrich_left", "enrich_stats", "load_lookup",
           "lookup_fits_broadcast", "prepare_lookup", "batch_max", "commit_gate", "fold_mark",
           "rename_columns", "select_mapped", "affected_rows", "insert_only", "insert_only_stats",
           "upsert", "reject_reason", "validate_messages", "validation_stats"]
