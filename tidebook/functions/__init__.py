"""Column expressions. Everything here stays inside whole-stage code generation."""

from tidebook.functions.dates import (  # noqa: F401
    add_month,
    calendar_columns,
    day_gap,
    first_month_after,
    first_month_from,
    month_gap,
    month_label,
    month_start,
)
from tidebook.functions.money import (  # noqa: F401
    exact_mean,
    exact_sum,
    exact_units,
    no_units,
    from_units,
    rate_mean,
    round_half_away,
    share_of,
)
from tidebook.functions.ratios import (  # noqa: F401
    percent_change,
    progress_to_ceiling,
    progress_to_floor,
    rag_status,
    ratio_or_null,
    ratio_or_zero,
    share_label,
)
