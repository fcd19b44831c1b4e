"""Property test: parse_date agrees with a plain-Python statement of its rules."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harvest.functions.dates import parse_date

RULES_TRIMMED = [r"([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})[ \t]+([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})",
                 r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})[ \t]+([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})"]
RULES_SPACELESS = [  # (pattern, roc offset, fields present)
    (r"([0-9]{1,3})", 1911, "y"), (r"([0-9]{1,3})[./]([0-9]{1,2})[./]([0-9]{1,2})", 1911, "ymd"),
    (r"([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", 0, "ymd"), (r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", 0, "ymd"),
    (r"([0-9]{4})([0-9]{2})([0-9]{2})", 0, "ymd"), (r"([0-9]{3})([0-9]{2})([0-9]{2})", 1911, "ymd"),
    (r"([0-9]{4})([0-9]{2})", 0, "ym"), (r"([0-9]{4})-([0-9]{1,2})", 0, "ym"), (r"([0-9]{4})", 0, "y"),
    (r"([0-9]{4})年", 0, "y")]


def spec(s):
    if s is None:
        return None
    raw = s.strip(" ")
    if "," in raw:
        return None

    def make(y, mo=1, d=1, h=0, mi=0, se=0):
        try:
            return dt.datetime(y, mo, d, h, mi, se)
        except ValueError:
            return None

    for pat in RULES_TRIMMED:
        m = re.fullmatch(pat, raw)
        if m:
            return make(*map(int, m.groups()))
    flat = raw.replace(" ", "")
    for pat, off, fields in RULES_SPACELESS:
        m = re.fullmatch(pat, flat)
        if m:
            g = list(map(int, m.groups()))
            g[0] += off
            return make(*g)
    return None


num = st.integers(0, 2100).map(str)
small = st.integers(0, 70).map(str)
pad2 = st.integers(0, 99).map(lambda x: f"{x:02d}")
date_like = st.one_of(
    st.builds(lambda y, m, d, sep: f"{y}{sep}{m}{sep}{d}", num, small, small, st.sampled_from(["/", "-", ".", ""])),
    st.builds(lambda y, m, d, h, mi, s, sep: f"{y}{sep}{m}{sep}{d} {h}:{mi}:{s}", st.integers(1000, 2100).map(str),
              small, small, small, small, small, st.sampled_from(["/", "-"])),
    st.builds(lambda y, m, d: f"{y}{m}{d}", st.integers(0, 2100).map(lambda x: f"{x:03d}"), pad2, pad2),
    st.builds(lambda y: f"{y}年", st.integers(0, 9999).map(str)),
    st.text(alphabet="0123456789/-. 年:,x", max_size=14),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(date_like, min_size=400, max_size=400))
def test_parse_date_matches_rule_spec(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    bad = [(v, g, spec(v)) for v, g in zip(values, got) if g != spec(v)]
    assert not bad, bad[:10]
