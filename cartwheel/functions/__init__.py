from cartwheel.functions.rates import (
    conversion_rate,
    decimal_percent_text,
    double_percent_text,
    fixed4_text,
    percent_points,
)
from cartwheel.functions.bands import alert_count_status, conversion_status, segment_colour

__all__ = [
    "conversion_rate",
    "decimal_percent_text",
    "double_percent_text",
    "fixed4_text",
    "percent_points",
    "alert_count_status",
    "conversion_status",
    "segment_colour",
]
