"""Column-level functions: name parsing, lenient casts, rounding, metric kinds.

All of them return native ``Column`` expressions, so they run inside
whole-stage codegen and never cross into a Python worker.
"""

from scorelake.functions.names import country_of, full_name_of, team_code_of
from scorelake.functions.scalars import (
    balls_from_overs,
    highest_score_text,
    round_half_up,
    safe_cast,
    span_years,
)

__all__ = [
    "balls_from_overs",
    "country_of",
    "full_name_of",
    "highest_score_text",
    "round_half_up",
    "safe_cast",
    "span_years",
    "team_code_of",
]
