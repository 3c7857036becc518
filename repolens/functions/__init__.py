"""Column expressions. Every function returns a ``Column`` built from
Spark built-ins, so it stays inside whole-stage codegen."""

from repolens.functions.dates import (  # noqa: F401
    date_range,
    days_since,
    month_start,
    period_range,
    round_to_day,
    shift_date,
    year_of,
)
from repolens.functions.text import join_topics_capped, split_topics  # noqa: F401
