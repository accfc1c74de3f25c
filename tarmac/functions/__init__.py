from tarmac.functions.measures import mean32, pct32, pct32_int
from tarmac.functions.text import half_day, padded_date, whole_number

__all__ = ["half_day", "mean32", "padded_date", "pct32", "pct32_int", "whole_number"]
