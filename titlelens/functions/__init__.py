"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from titlelens.functions.lists import split_list, explode_list, first_listed, json_list
from titlelens.functions.years import decade_of, decade_floor_of, is_four_digit_year

__all__ = ["split_list", "explode_list", "first_listed", "json_list", "decade_of", "decade_floor_of",
           "is_four_digit_year"]
