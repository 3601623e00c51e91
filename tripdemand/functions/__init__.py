"""Column-level building blocks (built-in expressions only, no UDFs)."""

from tripdemand.functions.text import (  # noqa: F401
    field, float_value, is_float_text, is_int_text, n_fields, tokens,
)
from tripdemand.functions.time import (  # noqa: F401
    block_label, day_name, month_name, parse_pickup, rebase_pickup_text, time_block,
)
