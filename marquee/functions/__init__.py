"""Column expressions."""

from marquee.functions.errors import error_text
from marquee.functions.years import intervals, range_bounds, year_ranges

__all__ = ["error_text", "intervals", "range_bounds", "year_ranges"]
