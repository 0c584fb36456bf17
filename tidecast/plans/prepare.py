"""Prepare: split, bin, remove outliers, impute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.functions import cells
from tidecast.operators.align import append
from tidecast.operators.clean import numeric_columns
from tidecast.operators.decompose import Penalties, fit_decomposition, impute, impute_category
from tidecast.operators.describe import mode_of
from tidecast.operators.position import Order
from tidecast.operators.windows import remove_outliers, split_holdout
from tidecast.session import write_scratch
from tidecast.sources import store
from tidecast.sources.readers import read_dataset
from tidecast.sources.writers import write_dataset

RAIN = "HourlyPrecipitation"


@dataclass(frozen=True)
class Prepared:
    """The clean table, the rows set aside, and what unseen data is filled with: the imputation models of the numeric
    columns and the most frequent level of every category, both of the training data.
    """

    clean: DataFrame | None
    holdout: DataFrame | None
    models: DataFrame
    columns: tuple[str, ...]
    modes: DataFrame

    def save(self, path: str) -> int:
        """Publish what unseen data needs; returns the version, see ``store.publish``."""
        tables = {"models": self.models, "modes": self.modes}
        return store.publish("prepared", tables, {"columns": self.columns}, path, self.models.sparkSession)

    def write(self, path: str, time: str = "time", mode: str = "error") -> None:
        """The clean table and the rows set aside as datasets, ``clean`` and ``holdout`` below ``path``."""
        write_dataset(self.clean, f"{path.rstrip('/')}/clean", time=time, mode=mode)
        if self.holdout is not None:
            write_dataset(self.holdout, f"{path.rstrip('/')}/holdout", time=time, mode=mode)


def load_prepared(spark: SparkSession, path: str, version: int | None = None) -> Prepared:
    """What an earlier run left for unseen data, without its tables of rows."""
    tables, known = store.fetch("prepared", path, spark, version)
    return Prepared(None, None, tables["models"], tuple(known["columns"]), tables["modes"])


def bin_rain(df: DataFrame, column: str = RAIN) -> DataFrame:
    """Precipitation as an ordered category; a table without it is left alone."""
    if column not in df.columns:
        return df
    return df.withColumn(column, cells.bin_label(column, cells.RAIN_EDGES, cells.RAIN_LABELS))


def one_hot(df: DataFrame, column: str, levels: Sequence[str], drop_first: bool = True) -> DataFrame:
    """Replace a category by its dummies, placed after the other columns."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*rest, *cells.dummies(column, levels, drop_first))


def process_dataset(df: DataFrame | str, order: Order, split: bool = False, train: bool = True,
                    trained: Prepared | None = None, rain: str = RAIN, n: int = 1000, p: float = 0.001,
                    fraction: float = 0.1) -> Prepared:
    """Clean a preliminary dataset.

    ``df`` is a table, or the path of a saved one.  With ``split`` the last tenth of every series is set aside untouched.
    ``train=False`` reuses the imputation models and the most frequent levels of an earlier run.
    """
    if isinstance(df, str):
        df = read_dataset(SparkSession.active(), df, time=order.time)
    if not isinstance(df, DataFrame):
        raise TypeError("the dataset must be a DataFrame")
    if not train and trained is None:
        raise ValueError("models are needed to process unseen data; run with train=True first")
    holdout = None
    if split and train:
        marked = split_holdout(df, order, fraction)
        holdout = marked.filter("is_holdout").drop("is_holdout")
        df = marked.filter("not is_holdout").drop("is_holdout")
    binned = bin_rain(df, rain)
    ids = (*order.keys, order.time, *order.ties)
    numbers = [c for c in numeric_columns(binned) if c not in ids]
    kept = remove_outliers(binned, numbers, order, n, p)
    columns = tuple(numbers) if train else trained.columns
    models = (write_scratch(fit_decomposition(kept, order, columns, [Penalties()]), "imputation") if train
              else trained.models)
    clean = impute(kept, models, columns, order)
    texts = [c for c in clean.columns if c not in (*ids, *numbers) and dict(clean.dtypes)[c] == "string"]
    modes = write_scratch(_modes(clean, texts), "modes") if train else trained.modes
    for c in texts:
        clean = impute_category(clean, c, modes.filter(F.col("variable") == c).select(F.col("level").alias(c), "n"))
    return Prepared(clean, holdout, models, columns, modes)


def _modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """variable, level and n: the most frequent level of every category."""
    found = [mode_of(df, c).select(F.lit(c).alias("variable"), F.col(f"`{c}`").alias("level"), "n") for c in columns]
    return append(*found) if found else df.sparkSession.createDataFrame([], "variable string, level string, n long")
