from .calendar import calendar_fields
from .coerce import bigint, coerce_to, epoch_millis, integer, truncated_decimal

__all__ = [
    "bigint",
    "calendar_fields",
    "coerce_to",
    "epoch_millis",
    "integer",
    "truncated_decimal",
]
