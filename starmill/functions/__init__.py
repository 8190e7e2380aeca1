from starmill.functions.calendar import calendar
from starmill.functions.scalars import (
    any_differs,
    date_key,
    default_to,
    differs,
    minute_index,
    null_tolerant_concat,
    seconds_between,
    time_literal,
)

__all__ = [
    "any_differs",
    "calendar",
    "date_key",
    "default_to",
    "differs",
    "minute_index",
    "null_tolerant_concat",
    "seconds_between",
    "time_literal",
]
