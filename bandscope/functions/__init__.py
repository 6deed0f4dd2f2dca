from bandscope.functions.bands import band, band_rank, value_rank
from bandscope.functions.casts import to_type
from bandscope.functions.measures import factor_aggregates

__all__ = ["band", "band_rank", "factor_aggregates", "to_type", "value_rank"]
