from tidemart.streaming.dim_log import DimLog
from tidemart.streaming.stateful import bounces, repair_new_visitors, unique_visits

__all__ = ["DimLog", "bounces", "repair_new_visitors", "unique_visits"]
