from tarmac.plans.questions import QUESTIONS, Question
from tarmac.plans.lookups import (
    best_flight_on,
    carriers_of_pair,
    destinations_of,
    mean_delay_of_pair,
    two_leg_trips,
)
from tarmac.plans.shared import SHARED_KEYS, shared_answers, shared_tally

__all__ = [
    "QUESTIONS",
    "Question",
    "SHARED_KEYS",
    "best_flight_on",
    "carriers_of_pair",
    "destinations_of",
    "mean_delay_of_pair",
    "shared_answers",
    "shared_tally",
    "two_leg_trips",
]
