from tarmac.streaming.idle import start_idle_counts
from tarmac.streaming.jobs import (
    BACKFILL,
    LIVE,
    Job,
    read_answer,
    rejects_of,
    start_console,
    start_question,
    start_rejects,
    start_shared,
)
from tarmac.streaming.counts import BadLines, LineCounts
from tarmac.streaming.paths import RunPaths, fresh_run, shared_folder
from tarmac.streaming.tallies import read_maintained, read_tally, save_tally, start_maintained, start_tally

__all__ = [
    "BACKFILL",
    "BadLines",
    "LIVE",
    "Job",
    "LineCounts",
    "RunPaths",
    "fresh_run",
    "read_answer",
    "read_maintained",
    "read_tally",
    "rejects_of",
    "save_tally",
    "shared_folder",
    "start_console",
    "start_idle_counts",
    "start_maintained",
    "start_question",
    "start_rejects",
    "start_shared",
    "start_tally",
]
