from tarmac.sources.kafka import kafka_lines
from tarmac.sources.landing import airports_of, land, landed_lines, landed_rejects, start_landing
from tarmac.sources.text import text_lines

__all__ = [
    "airports_of",
    "kafka_lines",
    "land",
    "landed_lines",
    "landed_rejects",
    "start_landing",
    "text_lines",
]
