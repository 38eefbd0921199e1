"""Trip analytics on Spark: cleaning, star tables, rollups and named queries."""

from tripmill.config import Settings
from tripmill.plans.tables import SavedTables, TripTables

__all__ = ["SavedTables", "Settings", "TripTables"]
