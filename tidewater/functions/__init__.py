from tidewater.functions.coerce import fill_missing, nan_to_null, try_number, try_timestamp
from tidewater.functions.json import decode_json, evaluate_once, json_kind, text_kind
from tidewater.functions.marks import Mark, encode_mark
from tidewater.functions.size import fits_broadcast, measure, size_metrics

__all__ = ["fill_missing", "nan_to_null", "try_number", "try_timestamp", "decode_json",
           "evaluate_once", "json_kind", "text_kind", "Mark", "encode_mark", "fits_broadcast",
           "measure", "size_metrics"]
