"""Constants of the trip model and the storage layout."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on them.
SERVICES = ("yellow", "green", "fhv")
START_MONTH = "2022-01"
END_MONTH = "2025-11"
MAX_TRIP_SECONDS = 14_400
LONG_TRIP_SECONDS = 2_700
TOP_ZONES = 50
SUBSET_ZONES = 30
SUBSET_MONTH = "2022-06"
SUBSET_SERVICE = "green"
SUBSET_BYTES = 10_000_000
TRAIN_END = "2024-12"
TEST_START = "2025-01"
SEED = 128
AIRPORT_ZONES = (132, 138, 1)
MIDTOWN_ZONES = (161, 162, 163)
ZONE_GROUPS = {"Airport": AIRPORT_ZONES, "Midtown": MIDTOWN_ZONES}
TREND_MIN_TRIPS = 1_000


@dataclass(frozen=True)
class Lake:
    """Where raw months are read and where layers are written."""

    raw: str
    out: str
    month_layout: str = "{root}/{year:04d}/{service}_tripdata_{year:04d}-{month:02d}.parquet"

    def month_path(self, service: str, year: int, month: int) -> str:
        return self.month_layout.format(root=self.raw, service=service, year=year, month=month)

    @property
    def silver(self) -> str:
        return f"{self.out}/silver/trips"

    @property
    def subset(self) -> str:
        return f"{self.out}/subset/trips"

    def gold(self, table: str) -> str:
        return f"{self.out}/gold/{table}"
