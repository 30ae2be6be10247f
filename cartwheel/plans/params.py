"""Parameters of the registered queries on the driver's test tables.

The library defaults stay 10 min / 1 min / > 100 / < 5; the test tables hold
about 10 events a minute over 30 days, so the registered window queries use
6 h / 1 h windows with views > 2 and purchases < 1 to produce alerts.
"""

WINDOW = "6 hours"
SLIDE = "1 hour"
WINDOW_HOURS = 6
MIN_VIEWS = 2
MAX_PURCHASES = 1
# D1 long-form window counts: same width, 2 h slide
D1_WINDOW = "6 hours"
D1_SLIDE = "2 hours"
# whole data range of the test tables (30 days from 2024-01-01), daily jobs back-fill every day
START = "2024-01-01"
END = "2024-02-01"
# the date a dashboard opened "today" shows (CURRENT_DATE replaced by a parameter)
AS_OF = "2024-01-15"
# replay harness: micro-batches per stream run and days per batch
DAYS_PER_BATCH = 8
