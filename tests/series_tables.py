"""Series tables for the tests."""

import numpy as np
import pandas as pd


def hours(n, start="2020-01-01"):
    return pd.date_range(start, periods=n, freq="h")


def frame(spark, pdf, partitions=4):
    """A Spark table of a pandas one with naive times, in shuffled row order."""
    mixed = pdf.sample(frac=1.0, random_state=3).astype(object).where(pdf.sample(frac=1.0, random_state=3).notna(), None)
    kinds = {"datetime64[ns]": "timestamp_ntz", "float64": "double", "int64": "long", "object": "string", "bool": "boolean"}
    schema = ", ".join(f"`{c}` {kinds[str(t)]}" for c, t in pdf.dtypes.items())
    rows = [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r)
            for r in mixed.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, schema).repartition(partitions)


def seasonal(n, seed=0, slope=0.01):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 100 + slope * t + 10 * np.sin(2 * np.pi * t / 24) + 5 * np.cos(2 * np.pi * t / 168) + rng.normal(0, 1, n)
