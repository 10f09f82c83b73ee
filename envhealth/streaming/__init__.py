"""The readings landing as a stream: each file is cleaned once, when it arrives."""

from .landing import clean_landing
from .outcomes import land_readings, landed_readings, landed_rejects

__all__ = ["clean_landing", "land_readings", "landed_readings", "landed_rejects"]
