import datetime as dt

from harvest.functions.dates import parse_date, roc_to_ad

D = dt.datetime

CASES = [
    ("111", D(2022, 1, 1)), ("99/9/9", D(2010, 9, 9)), ("111.10.17", D(2022, 10, 17)),
    ("111.10/17", D(2022, 10, 17)), ("111/2/30", None), ("1130512", D(2024, 5, 12)),
    ("2025/1/2", D(2025, 1, 2)), ("2025-01-02", D(2025, 1, 2)), ("20250102", D(2025, 1, 2)),
    ("202511", D(2025, 11, 1)), ("202501", D(2025, 1, 1)), ("2025-3", D(2025, 3, 1)),
    ("2025", D(2025, 1, 1)), ("2025年", D(2025, 1, 1)), ("113年", None),
    ("2025/01/02 10:11:12", D(2025, 1, 2, 10, 11, 12)), ("2025-01-02T10:00:00", None),
    ("", None), (None, None), ("text", None), (" 2025 / 1 / 2 ", D(2025, 1, 2)),
    ("2025-1-2 3:4:5", D(2025, 1, 2, 3, 4, 5)), ("113/2/29", D(2024, 2, 29)), ("2023/2/29", None),
    ("1,2,3,4,5,6,7", None), ("2025/13/01", None), ("0", D(1911, 1, 1)),
    ("2025/1/2 3:4:60", None), ("0000/01/01", None), ("00000101", None), ("2025/1/2 24:0:0", None), ("2025/1/2 3:60:0", None),
]


def test_parse_date_edge_rows(spark):
    df = spark.createDataFrame([(s,) for s, _ in CASES], "s string")
    got = {r[0]: r[1] for r in df.select("s", parse_date("s")).collect()}
    for s, want in CASES:
        assert got[s] == want, (s, got[s], want)


def test_roc_to_ad(spark):
    rows = spark.createDataFrame([("111",), ("x",)], "y string").select(roc_to_ad("y")).collect()
    assert [r[0] for r in rows] == [2022, None]
