"""Column helpers: text, time and exact arithmetic."""
from .columns import (  # noqa: F401
    as_double,
    as_int,
    day_key,
    from_epoch,
    front_article,
    keep_chars,
    mean_exact,
    mean_of_parts,
    mean_parts,
    members,
    percent_exact,
    proper,
    squeeze,
    trailing_year,
    without_year,
)
