"""Expression helpers used by the operators."""

from .bands import AGE_BANDS, age_band
from .grid import NEIGHBOUR_OFFSETS, cell_index, offset_rows, packed
from .money import MONEY_DIGITS, money_aggregates, money_columns, money_merge, money_total
from .sizing import BROADCAST_BYTES, fits_broadcast
from .synthetic import letters, uniform_int

__all__ = [
    "AGE_BANDS",
    "BROADCAST_BYTES",
    "MONEY_DIGITS",
    "NEIGHBOUR_OFFSETS",
    "age_band",
    "cell_index",
    "fits_broadcast",
    "letters",
    "money_aggregates",
    "money_columns",
    "money_merge",
    "money_total",
    "offset_rows",
    "packed",
    "uniform_int",
]
