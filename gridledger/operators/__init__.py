"""DataFrame in, DataFrame out."""

from .clustering import assign_centres, kmeans
from .customers import (
    age_gender_spend,
    country_size_outliers,
    country_txn_report,
    customer_txn_summary,
    least_active_customers,
)
from .density import grid_cell_counts, rank_cells, relative_density, top_dense_cells, top_dense_neighbors
from .neighbours import neighbour_counts
from .spatial import distance_outliers, spatial_join
from .transactions import (
    customer_count_pair,
    customer_txn_counts,
    filter_min_total,
    items_spend_stats,
    rare_big_spenders,
    rare_of_counts,
)

__all__ = [
    "age_gender_spend",
    "assign_centres",
    "country_size_outliers",
    "country_txn_report",
    "customer_count_pair",
    "customer_txn_counts",
    "customer_txn_summary",
    "distance_outliers",
    "filter_min_total",
    "grid_cell_counts",
    "items_spend_stats",
    "kmeans",
    "least_active_customers",
    "neighbour_counts",
    "rank_cells",
    "rare_big_spenders",
    "rare_of_counts",
    "relative_density",
    "spatial_join",
    "top_dense_cells",
    "top_dense_neighbors",
]
