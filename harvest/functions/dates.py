"""Multi-format date parsing as one JVM column expression.

Accepted inputs, tried in order (first match wins; an invalid calendar date
such as Feb 30 gives NULL instead of falling through):

* ``yyyy/M/d H:m:s`` and ``yyyy-M-d H:m:s`` on the trimmed value (matched
  before spaces are removed, so both date-time forms really parse);
* after removing every space:
  * ``\\d{1,3}``                    ROC year -> Jan 1 of (year + 1911)
  * ``\\d{1,3}[./]\\d{1,2}[./]\\d{1,2}`` ROC date
  * ``yyyy/M/d``, ``yyyy-M-d``
  * ``\\d{8}`` yyyyMMdd, ``\\d{7}`` ROC yyyMMdd, ``\\d{6}`` yyyyMM
  * ``yyyy-M``, ``yyyy``, ``yyyy年``

Anything else (including ``113年``, ``2025/01``, ISO ``T`` forms, empty and
NULL) is NULL. NULL sorts first and is dropped by a cutoff filter, which is
how the minimum-date sentinel behaves in the original tool.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROC_OFFSET = 1911


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def roc_to_ad(year: Column) -> Column:
    """ROC year text -> AD year (int), NULL when not a number."""
    return _c(year).cast("string").try_cast("int") + F.lit(ROC_OFFSET)


# Fixed patterns. Date-times apply to the trimmed value (one separator, used
# twice); everything else to the value with every space removed, as ordered
# alternatives of one anchored regex -- the first alternative that matches the
# whole value wins, which is the rule priority. Four-digit years exclude 0000
# and seconds stop at 59, as the original's calendar type does.
_DATETIME = r"^(?!0000)(\d{4})([/-])(\d{1,2})\2(\d{1,2})\s+(\d{1,2}):(\d{1,2}):([0-5]?\d)$"
_DATETIME_OUT = "$1,$3,$4,$5,$6,$7"
_DATE_RULES = [                                   # (alternative, year group(s), month, day)
    r"(\d{1,3})",                                 # ROC year              g1
    r"(\d{1,3})[./](\d{1,2})[./](\d{1,2})",       # ROC y.M.d / y/M/d     g2 g3 g4
    r"(?!0000)(\d{4})/(\d{1,2})/(\d{1,2})",       # yyyy/M/d              g5 g6 g7
    r"(?!0000)(\d{4})-(\d{1,2})-(\d{1,2})",       # yyyy-M-d              g8 g9 g10
    r"(?!0000)(\d{4})(\d{2})(\d{2})",             # yyyyMMdd              g11 g12 g13
    r"(\d{3})(\d{2})(\d{2})",                     # ROC yyyMMdd           g14 g15 g16
    r"(?!0000)(\d{4})(\d{2})",                    # yyyyMM                g17 g18
    r"(?!0000)(\d{4})-(\d{1,2})",                 # yyyy-M                g19 g20
    r"(?!0000)(\d{4})",                           # yyyy                  g21
    r"(?!0000)(\d{4})年",                          # yyyy年                g22
]
_DATE = "^(?:" + "|".join(_DATE_RULES) + ")$"
# Only the matched alternative's groups are non-empty: year, month, day, then a
# midnight time. A 1-3 digit year is an ROC year (the only rules that take one).
_DATE_OUT = "$1$2$5$8$11$14$17$19$21$22,$3$6$9$12$15$18$20,$4$7$10$13$16,0,0,0"
ROC_MAX_YEAR_DIGITS = 3


def canonical_date_text(col) -> Column:
    """The value rewritten as ``y,m,d,h,mi,s`` by the first matching rule, or a
    value without commas when none matches.

    Inputs that already contain a comma are emptied first (no rule accepts
    them); a date-time rewrite contains commas, which the date rules never
    accept, so only one rewrite can fire. The input is referenced once."""
    x = F.regexp_replace(F.trim(_c(col).cast("string")), r"^.*,.*$", "")
    x = F.regexp_replace(x, _DATETIME, _DATETIME_OUT)
    x = F.regexp_replace(x, " ", "")
    return F.regexp_replace(x, _DATE, _DATE_OUT)


def parse_date(col) -> Column:
    """string (or any value, cast to string) -> TIMESTAMP_NTZ or NULL.

    The rewrite runs once per row: its split parts are bound to a lambda
    variable (a one-element ``transform``), so filters -- where Spark does not
    eliminate common subexpressions -- do not repeat it per date part.
    """
    parts = F.array(F.split(canonical_date_text(col), ","))

    def build(p: Column) -> Column:
        def part(i: int, default: int | None = None) -> Column:
            v = F.get(p, i)
            v = F.when(v != "", v)
            return (F.coalesce(v, F.lit(str(default))) if default is not None else v).try_cast("int")
        year_text = F.get(p, 0)
        roc = F.when(F.length(year_text) <= ROC_MAX_YEAR_DIGITS, F.lit(ROC_OFFSET)).otherwise(F.lit(0))
        # A value no rule rewrote has no 6th part -> NULL.
        return F.try_make_timestamp_ntz(
            years=part(0) + roc, months=part(1, 1), days=part(2, 1),
            hours=part(3), mins=part(4), secs=part(5).cast("decimal(16,6)"))

    return F.get(F.transform(parts, build), 0)
