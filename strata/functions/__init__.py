"""Column-level helpers: all JVM-side built-in expressions (no UDFs)."""

from strata.functions.columns import (  # noqa: F401
    clock_minutes,
    first_address,
    history_text,
    ipv4_to_long,
    json_props,
    tier,
)
from strata.functions.bitmaps import (  # noqa: F401
    activity_bits,
    bit_flags,
    bits_text,
)
