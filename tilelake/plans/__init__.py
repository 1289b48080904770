from tilelake.plans.gold import read_gold, refresh_gold
from tilelake.plans.kept_cities import index_version, with_kept_cities
from tilelake.plans.silver import RunStatistics, bronze_to_silver, locate, to_silver

__all__ = [
    "RunStatistics", "bronze_to_silver", "index_version", "locate", "read_gold", "refresh_gold", "to_silver", "with_kept_cities",
]
