from tilelake.sinks.live import is_live_table, snapshot, vacuum
from tilelake.sinks.silver import adopt, drop_table, read_silver, register_silver, write_silver
from tilelake.sinks.tables import write_table

__all__ = [
    "adopt", "drop_table", "is_live_table", "read_silver", "register_silver", "snapshot", "vacuum", "write_silver", "write_table",
]
