"""Ranges mean UTC whatever the zone of the driver's machine is."""

import os
import subprocess
import sys

CODE = """
from cartwheel.session import build_session
from cartwheel.sources.tables import in_closed_range, in_range
spark = build_session("local[2]", shuffle_partitions=2)
hours = spark.sql("select explode(sequence(timestamp'2024-01-15 00:00:00', timestamp'2024-01-15 23:00:00', interval 1 hour)) as event_time")
for kind in ("timestamp", "timestamp_ntz"):
    df = hours.select(hours.event_time.cast(kind).alias("event_time"))
    print("ROWS", in_range(df, "2024-01-15", "2024-01-16").count(),
          in_range(df, "2024-01-14T19:00:00-05:00", None).count(),
          in_closed_range(df, "2024-01-15 05:00:00", "2024-01-15 06:00:00", "event_time").count())
"""


def test_ranges_on_a_machine_outside_utc():
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"TZ": "America/New_York", "PYTHONPATH": home}
    out = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=home, capture_output=True, text=True, timeout=300)
    assert [line.split()[1:] for line in out.stdout.splitlines() if line.startswith("ROWS")] == [["24", "24", "2"]] * 2, out.stderr[-2000:]
