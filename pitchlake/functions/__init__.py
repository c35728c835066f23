"""Column -> Column expressions: parsing, name resolution, clocks and rates."""

from pitchlake.functions import clock, names, parse, rates

__all__ = ["clock", "names", "parse", "rates"]
