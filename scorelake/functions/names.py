"""Player text -> (full name, country)  (C1-C3, C5).

A raw player cell looks like ``SR Tendulkar (INDIA)`` or ``Y Khan (ICC/PAK)``.
It is split on single spaces (empty tokens kept):

* the full name is every token that has no ``(``, re-joined by one space;
* the team code is the *last* token that has a ``(``, minus its first and
  last character (``""`` when no token has one);
* the country is the name of the first code key, in ``COUNTRY_CODES`` order,
  that occurs anywhere in the team code (case-sensitive); none -> NULL.

Both string operations are single regular expressions, which Spark compiles
once per task and runs inside generated code (a split/filter/join with
higher-order functions would fall out of codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelake.specs import COUNTRY_CODES

# A token holding "(" together with the single space before it.  Prefixing
# the text with one space makes the first token look like the others, so a
# global replace drops exactly the bracketed tokens and their separators.
_BRACKET_TOKEN_WITH_SEP = r" [^ ]*\([^ ]*"
# Inside of the last token holding "(": the token must hold "(" (look-ahead),
# its first and last characters are outside the group, and no later token
# may hold "(".  A one-character token does not match, giving "" as
# slicing [1:-1] would.
_LAST_BRACKET_CODE = r"(?:^| )(?=[^ ]*\()[^ ]([^ ]*)[^ ](?: [^ (]*)*\z"
# Any code key anywhere: equivalent to "the CASE below is not NULL".
KNOWN_CODE_PATTERN = "|".join(rf"\Q{key}\E" for key, _ in COUNTRY_CODES)


def full_name_of(player: Column) -> Column:
    """Tokens without "(" joined by single spaces (double spaces survive)."""
    stripped = F.regexp_replace(F.concat(F.lit(" "), player), _BRACKET_TOKEN_WITH_SEP, "")
    return F.substring(stripped, 2, 2**31 - 1)


def team_code_of(player: Column) -> Column:
    """The last bracketed token without its first and last character."""
    return F.regexp_extract(player, _LAST_BRACKET_CODE, 1)


def has_known_code(code: Column) -> Column:
    """C5 as one pattern test: some key of the code map occurs in ``code``.

    Filtering on this instead of ``country IS NOT NULL`` matters for the
    plan: Catalyst pushes the filter below the projection, and a CASE over
    24 keys would then re-evaluate the code extraction once per branch.
    """
    return code.rlike(KNOWN_CODE_PATTERN)


def country_of(code: Column) -> Column:
    """First code key (in fixed order) contained in ``code``; else NULL."""
    expr = None
    for key, name in COUNTRY_CODES:
        cond = code.contains(key)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr
