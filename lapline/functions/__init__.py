"""Column expressions: everything here stays JVM-side (no UDF)."""

from lapline.functions.times import (  # noqa: F401
    bad_time_counts, centis, convert_time_columns, format_seconds, half_up_mean, time_to_seconds, to_double,
)
from lapline.functions.text import (  # noqa: F401
    last_path_element, py_squash, py_strip, regex_contains, soft_hyphen_to_dash, splitlines, upper_contains,
)
