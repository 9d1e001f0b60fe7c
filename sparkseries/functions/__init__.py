from sparkseries.functions.text import parse_decimal, parse_timestamp, to_number
from sparkseries.functions.timegrid import bucket, day_index

__all__ = ["bucket", "day_index", "parse_decimal", "parse_timestamp", "to_number"]
