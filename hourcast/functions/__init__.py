"""Column-expression builders (all JVM-side built-ins; no Python UDFs)."""

from hourcast.functions.time import (  # noqa: F401
    as_date, hour_of_day, is_ntz, iso_weekday, next_day, parse_timestamp, trunc_day,
    trunc_hour, utc_day, within_complete_days)
from hourcast.functions.numeric import (  # noqa: F401
    keyed_jitter, relative_change, round_numeric, round_double, safe_divide, to_double)
from hourcast.functions.expressions import (  # noqa: F401
    bucket, day_type, default_fill, demand_feature_columns, is_blank, strip_ws)
