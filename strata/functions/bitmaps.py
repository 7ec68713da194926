"""Activity bitmaps over date lists, without any join.

A bitmap packs "was the entity active on day snapshot - d" into bit
``top_bit - d`` of a 64-bit integer, for ``d`` in ``[0, window)``. The
reference builds it with a cross join against a date series and a SUM;
here it is a higher-order ``aggregate`` over the entity's own array, so
no row multiplication and no shuffle take place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def activity_bits(dates: Column | str, snapshot: Column | str, *, window: int = 30,
                  top_bit: int = 31, word_bits: int = 32) -> Column:
    """Bitmap of activity days in ``(snapshot - window, snapshot]``.

    ``top_bit`` is the bit of the snapshot day itself. Bits that land at
    or above ``word_bits`` are cut away, as a ``BIT(word_bits)`` column
    does (``top_bit = 32`` reproduces the off-by-one of a 32-bit word that
    loses the snapshot day). Duplicate dates count once.
    """
    d = F.col(dates) if isinstance(dates, str) else dates
    s = F.col(snapshot) if isinstance(snapshot, str) else snapshot
    in_window = F.filter(d, lambda x: (F.datediff(s, x) >= 0) & (F.datediff(s, x) < window))
    mask = F.lit((1 << word_bits) - 1).cast("long")

    def bit(x):
        shift = F.lit(top_bit) - F.datediff(s, x)
        one = F.lit(1).cast("long")
        return F.when(shift < word_bits, F.call_function("shiftleft", one, shift)).otherwise(F.lit(0).cast("long"))

    bits = F.aggregate(F.coalesce(in_window, F.array().cast("array<date>")), F.lit(0).cast("long"),
                       lambda acc, x: acc.bitwiseOR(bit(x)))
    return bits.bitwiseAND(mask)


def bit_flags(bits: Column | str, *, word_bits: int = 32, week: int = 7) -> dict[str, Column]:
    """Monthly / weekly / daily activity flags from the high bits of a word."""
    b = F.col(bits) if isinstance(bits, str) else bits
    week_mask = ((1 << week) - 1) << (word_bits - week)
    day_mask = 1 << (word_bits - 1)
    return {
        "is_monthly_active": F.bit_count(b) > 0,
        "is_weekly_active": F.bit_count(b.bitwiseAND(F.lit(week_mask).cast("long"))) > 0,
        "is_daily_active": F.bit_count(b.bitwiseAND(F.lit(day_mask).cast("long"))) > 0,
    }


def bits_text(bits: Column | str, word_bits: int = 32) -> Column:
    """Bitmap as fixed-width ``0``/``1`` text, most significant bit first."""
    b = F.col(bits) if isinstance(bits, str) else bits
    return F.lpad(F.bin(b), word_bits, "0")
