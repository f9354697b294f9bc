from lamina.functions.checks import as_number, positive, present
from lamina.functions.money import line_total
from lamina.functions.salting import random_salt, salted_key, steady_salt
from lamina.functions.text import lowered, titled, trimmed

__all__ = [
    "as_number",
    "line_total",
    "lowered",
    "positive",
    "present",
    "random_salt",
    "salted_key",
    "steady_salt",
    "titled",
    "trimmed",
]
