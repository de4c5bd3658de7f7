"""Column expressions used by the operators."""

from lodgeflow.functions.dates import parse_date
from lodgeflow.functions.geo import clean_coordinate
from lodgeflow.functions.numeric import as_compared, as_decimal, as_number, percent, percent_of
from lodgeflow.functions.text import digits_only, lower_trim, strip_special, title_text, upper_text

__all__ = ["parse_date", "clean_coordinate", "as_compared", "as_decimal", "as_number", "percent", "percent_of",
           "digits_only", "lower_trim", "strip_special", "title_text", "upper_text"]
