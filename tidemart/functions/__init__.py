from tidemart.functions.numbers import div_half_up, uj_rate, dur_per_sv, pv_per_sv
from tidemart.functions.times import (
    age_years,
    day_of_millis,
    millis_of_text,
    millis_to_second,
    parse_time,
    processing_time_millis,
    time_text,
)

__all__ = [
    "age_years",
    "day_of_millis",
    "div_half_up",
    "dur_per_sv",
    "millis_of_text",
    "millis_to_second",
    "parse_time",
    "processing_time_millis",
    "pv_per_sv",
    "time_text",
    "uj_rate",
]
