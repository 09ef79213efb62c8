"""Parameters of the registered queries.

The events table is sparser than real sensor data, so windows are wider than
the operators' defaults.
"""

from __future__ import annotations

NOW = "2024-01-31 00:00:00"

RANGES = {"click": (5.0, 100.0), "error": (5.0, 100.0), "purchase": (4.0, 140.0),
          "view": (3.0, 90.0)}
RANGES_JSON = (
    '{"click": {"max": 100, "min": 5}, "error": {"max": 100, "min": 5}, '
    '"purchase": {"max": 140, "min": 4}, "view": {"max": 90, "min": 3}}'
)
CAPS = {"click": (20, 1), "error": (6, 1), "purchase": (10, 1), "signup": (1, 1),
        "view": (40, 1)}
CLASSES = {"click": "short", "view": "short", "purchase": "short", "error": "long"}
GAPS = {"short": 86_400, "long": 2 * 86_400}

PATIENT = "00000000-0000-0000-0000-000000000007"
FRAGMENT = "0001"
WEEK_MS = (1_706_054_400_000, 1_706_659_200_000)  # 2024-01-24 to 2024-01-31
MONTH_MS = (1_704_067_200_000, 1_706_659_200_000)  # 2024-01-01 to 2024-01-31
DRIFT_FROM = "2024-01-16 00:00:00"
WATCHED_ABOVE = 200.0
FIRST_DAY_ENDS = "2024-01-02 00:00:00"
QUIET_SECONDS = 6 * 3600
HALF = "2024-01-16 00:00:00"
# Edges of the time slices that streams read one by one; together all of the data.
SLICES = ("1970-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "2100-01-01")
# Streams: how long a series may be silent, how far arrivals may be out of order, rows a write.
EXPIRE = "2 days"
EXPIRE_US = 2 * 86_400_000_000
ARRIVAL_DELAY = "2 days"
CHUNK_ROWS = 500
