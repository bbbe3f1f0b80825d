"""Phone-number masks.

Two masks exist upstream: the order-landing job keeps the last four digits, the
sale job keeps the first four. ``substring`` never throws, so a short number yields
whatever characters are there instead of failing the batch.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the seven-star filler used by both masks.
MASK = "*******"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_tel_tail(tel) -> Column:
    """Keep characters 8..11 (the last four of an 11-digit number): ``*******4075``."""
    return F.concat(F.lit(MASK), F.substring(_c(tel), 8, 4))


def mask_tel_head(tel) -> Column:
    """Keep the first four characters: ``1350*******``."""
    return F.concat(F.substring(_c(tel), 1, 4), F.lit(MASK))
