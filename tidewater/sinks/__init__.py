from tidewater.sinks.bucketed import read_bucketed, upsert_bucketed
from tidewater.sinks.control import append_control, read_control
from tidewater.sinks.events import append_daily, to_sink_rows
from tidewater.sinks.files import write_per_file_text
from tidewater.sinks.jdbc import merge_statement, upsert_jdbc
from tidewater.sinks.versioned import current_version, publish, read_current

__all__ = ["read_bucketed", "upsert_bucketed", "append_control", "read_control", "append_daily",
           "to_sink_rows", "write_per_file_text", "merge_statement", "upsert_jdbc",
           "current_version", "publish", "read_current"]
