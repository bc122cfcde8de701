from stratum.functions.normalize import (  # noqa: F401
    PRIORITY_LABELS,
    normalize_domain,
    reject_reason,
    strict_int,
)
from stratum.functions.numeric import round_scaled, to_int_half_even  # noqa: F401
from stratum.functions.timefn import (  # noqa: F401
    add_seconds,
    day_slice,
    hours_crossed,
    in_window,
    on_day_wrapped,
    seconds_between,
)
