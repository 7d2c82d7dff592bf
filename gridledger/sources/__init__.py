"""Text scans, text sinks and synthetic datasets."""

from .generators import gen_customers, gen_points, gen_rectangles, gen_seeds, gen_transactions
from .keyed import per_key, read_keyed, write_keyed
from .placed import read_window, write_points
from .sinks import write_csv, write_kmeans_rounds, write_lines
from .text import (
    read_centres,
    read_csv,
    read_customers,
    read_mixed,
    read_points,
    read_rectangles,
    read_transactions,
    split_mixed,
    split_records,
)

__all__ = [
    "gen_customers",
    "gen_points",
    "gen_rectangles",
    "gen_seeds",
    "gen_transactions",
    "per_key",
    "read_centres",
    "read_csv",
    "read_customers",
    "read_keyed",
    "read_mixed",
    "read_points",
    "read_rectangles",
    "read_transactions",
    "read_window",
    "split_mixed",
    "split_records",
    "write_csv",
    "write_keyed",
    "write_kmeans_rounds",
    "write_lines",
    "write_points",
]
