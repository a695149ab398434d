from cityobs.streaming.arrivals import arriving_rows, clean_arrivals, clean_arriving_files, read_cleaned
from cityobs.streaming.latency import (
    arriving_events,
    dropped_as_late,
    pair_arrivals,
    pair_arriving,
    read_running_latency,
    running_latency,
)

__all__ = [
    "arriving_events",
    "arriving_rows",
    "clean_arrivals",
    "clean_arriving_files",
    "dropped_as_late",
    "pair_arrivals",
    "pair_arriving",
    "read_cleaned",
    "read_running_latency",
    "running_latency",
]
