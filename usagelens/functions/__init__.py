"""Column-expression helpers: guarded casts and display labels."""

from usagelens.functions.casts import (
    format_event_ts,
    lookup,
    parse_event_ts,
    safe_bool,
    safe_float,
    safe_int,
    strip_ws,
)
from usagelens.functions.labels import (
    error_label,
    heatmap_day_order,
    model_short_name,
    pseudonym,
    weekday_name,
)

__all__ = [
    "error_label", "format_event_ts", "heatmap_day_order", "lookup", "model_short_name",
    "parse_event_ts", "pseudonym", "safe_bool", "safe_float", "safe_int", "strip_ws",
    "weekday_name",
]
