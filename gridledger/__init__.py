"""Batch analytics on Spark: customer and spending reports, planar joins, clustering, density."""

from .operators import *  # noqa: F403
from .operators import __all__  # noqa: F401
