from cartwheel.sources.adapter import clickstream_from_events, wire_from_events
from cartwheel.sources.tables import load_table, read_events_range

__all__ = ["clickstream_from_events", "wire_from_events", "load_table", "read_events_range"]
