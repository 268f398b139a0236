"""What the tests share."""

from __future__ import annotations

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows_of(table) -> list[tuple]:
    """Sorted rows of a pandas frame, columns by name, doubles rounded, all missing values alike."""
    import pandas as pd

    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(int(v))
        if isinstance(v, str):
            return v
        return f"{float(v):.6g}" if abs(float(v)) < 1e15 else str(int(v))

    names = sorted(table.columns)
    return sorted(tuple(plain(v) for v in row) for row in table[names].itertuples(index=False))
