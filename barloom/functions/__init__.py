"""Column expressions shared by the feature and label plans."""
from barloom.functions.expr import (  # noqa: F401
    above,
    direction_label,
    gain,
    guarded_ratio,
    loss,
    pct_change,
    reward_risk,
    round_even,
    round_half_up,
    rsi_from_means,
    safe_ratio,
)
from barloom.functions.timezone import (  # noqa: F401
    IST,
    iso_to_ist,
    ist_to_utc,
    to_ist,
    to_iso_ist,
)
