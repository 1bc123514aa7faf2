from .numeric import cyclic, log1p_zero, nan_to_null, percent_rate, relative_shift
from .text import (extract_json_block, is_http_url, join_url, name_tokens, normalize_name,
                   squash_name)
from .timeparse import (day_window, format_time, hour_bucket, parse_mixed_timestamp, parse_time,
                        shift_days)

__all__ = [
    "cyclic", "log1p_zero", "nan_to_null", "percent_rate", "relative_shift",
    "extract_json_block", "is_http_url", "join_url", "name_tokens", "normalize_name",
    "squash_name", "day_window", "format_time", "hour_bucket", "parse_mixed_timestamp",
    "parse_time", "shift_days",
]
