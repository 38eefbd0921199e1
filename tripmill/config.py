"""Everything a caller may want to vary, with the customary defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Scope and thresholds shared by the load job and the queries."""

    # Borough whose trips are loaded and reported on.
    home: str = "Manhattan"
    # Day the "recent" window ends; None means the latest pickup date in the fact table.
    as_of: dt.date | None = None
    recent_days: int = 30
    # Smallest group kept by the route, route-pair and airport-origin reports.
    min_od_trips: int = 100
    min_pair_trips: int = 500
    min_airport_trips: int = 50
    # Whether loads keep sketches of values beside exact counts, for reports asked for with ``approx``.
    sketches: bool = False
    # Whether the incremental load reads the central business district fee; a load takes what its files were opened with.
    cbd_fee: bool = False
