"""SQL fragments shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations


def human_size_sql(b: str) -> str:
    """F08 in SQL: exact integer rounding (half-even) of bytes / 2**shift."""
    def scaled(mult: int, shift: str) -> str:
        n = f"(({b}) * {mult})"
        q = f"({n} >> {shift})"
        r = f"({n} - ({q} << {shift}))"
        half = f"(CAST(1 AS BIGINT) << ({shift} - 1))"
        return f"({q} + CASE WHEN {r} > {half} OR ({r} = {half} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"

    parts = []
    for shift, unit, lo in ((10, "KB", None), (20, "MB", 1000 * 1024), (30, "GB", 1000 * 1024 ** 2),
                            (40, "TB", 1000 * 1024 ** 3)):
        hi = {10: 1000 * 1024, 20: 1000 * 1024 ** 2, 30: 1000 * 1024 ** 3, 40: None}[shift]
        d = f"(CAST(1 AS BIGINT) << {shift})"
        q100, q10 = scaled(100, str(shift)), scaled(10, str(shift))
        two = f"CAST({q100} // 100 AS VARCHAR) || '.' || lpad(CAST({q100} % 100 AS VARCHAR), 2, '0')"
        one = f"CAST({q10} // 10 AS VARCHAR) || '.' || CAST({q10} % 10 AS VARCHAR)"
        whole = f"CAST(({b}) >> {shift} AS VARCHAR)"
        num = f"CASE WHEN ({b}) < {d} * 10 THEN {two} WHEN ({b}) < {d} * 100 THEN {one} ELSE {whole} END"
        cond = f"({b}) < {hi}" if hi else "TRUE"
        parts.append(f"WHEN {cond} THEN {num} || ' {unit}'")
    return (f"(CASE WHEN ({b}) IS NULL THEN NULL WHEN ({b}) = 0 THEN '0 B' "
            f"WHEN ({b}) < 100 THEN CAST({b} AS VARCHAR) || ' B' " + " ".join(parts) + " END)")
