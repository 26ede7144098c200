from .filters import drop_where_not_equal
from .joins import left_match, salt_pair
from .latest import latest_one, latest_rows, latest_rows_by_join, max_per_key
from .layout import range_clustered, replicated, write_distributed
from .surrogate import next_id, with_dense_id, with_id

__all__ = [
    "drop_where_not_equal",
    "latest_one",
    "latest_rows",
    "latest_rows_by_join",
    "left_match",
    "max_per_key",
    "next_id",
    "range_clustered",
    "replicated",
    "salt_pair",
    "with_dense_id",
    "with_id",
    "write_distributed",
]
