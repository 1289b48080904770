from tilelake.streaming.incremental import incremental_silver, read_incremental

__all__ = ["incremental_silver", "read_incremental"]
