"""Order-insensitive comparison of two results."""

import pandas as pd


def rows(frame, columns):
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        if isinstance(v, bool):
            return str(v)
        return f"{float(v):.6f}" if isinstance(v, (int, float)) or type(v).__module__ == "numpy" and str(v).replace(".", "").replace("-", "").replace("e", "").isdigit() else str(v)

    return sorted(tuple(str(plain(v)) for v in r) for r in frame[columns].itertuples(index=False))


def same(spark_frame, duck_frame):
    columns = sorted(spark_frame.columns)
    assert columns == sorted(duck_frame.columns)
    assert rows(spark_frame, columns) == rows(duck_frame, columns)
