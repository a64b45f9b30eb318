from tidemart.plans.backfill import Backfill, Settings
from tidemart.plans.pipelines import visitor_stats_from_log

__all__ = ["Backfill", "Settings", "visitor_stats_from_log"]
