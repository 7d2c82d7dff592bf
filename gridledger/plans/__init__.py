"""The operators as named queries over the given tables, and SQL to check them."""

from .oracles import build_oracles
from .queries import build_queries

__all__ = ["build_oracles", "build_queries"]
