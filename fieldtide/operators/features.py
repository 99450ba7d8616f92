"""One-hot columns fitted on one table and applied to others."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtide.operators import ordered
from fieldtide.session import stored

MOST = 10_000  # categories of one column that may become columns


@dataclass(frozen=True)
class OneHot:
    """Categories per column, in alphabetical order, with a name of their own for each."""

    names: dict[str, dict]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add a 0/1 column per known category; an unseen category gives zeros only."""
        added = {}
        for column, listed in self.names.items():
            for value, name in listed.items():
                added[name] = F.coalesce((F.col(column) == F.lit(value)).cast("int"), F.lit(0))
        return df.withColumns(added)


def _names(column: str, values: Sequence, taken: set[str]) -> dict:
    """A name per category: its letters and digits, with a number where another category has the same."""
    out = {}
    for value in values:
        plain = name = f"{column}_{re.sub(r'[^0-9A-Za-z]+', '_', str(value))}"
        n = 1
        while name.lower() in taken:  # Spark does not tell upper from lower case in names
            n += 1
            name = f"{plain}_{n}"
        taken.add(name.lower())
        out[value] = name
    return out


def one_hot(train: DataFrame, cols: Sequence[str]) -> OneHot:
    """Learn the categories of ``cols``. Each becomes a column of the result; a column of more than ``MOST`` categories
    is refused, as it needs ``one_hot_vector``."""
    taken = {c.lower() for c in train.columns}
    found = {}
    for column in cols:
        rows = train.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST + 1).collect()
        if len(rows) > MOST:
            raise ValueError(f"{column} has more than {MOST} categories: use one_hot_vector")
        found[column] = _names(column, sorted(r[0] for r in rows), taken)
    return OneHot(found)


@dataclass(frozen=True)
class OneHotVectors:
    """(value, place) per column, stored, and how many values there are; the places are in alphabetical order from 0."""

    places: dict[str, DataFrame]
    sizes: dict[str, int]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<col>_idx`` and the sparse vector ``<col>_vec``; an unseen category or NULL gives zeros only.

        The categories are joined to the rows, so no task holds all of them.
        """
        for column, listed in self.places.items():
            known = listed.select(F.col("value").alias("_value"), F.col("place").alias("_place"))
            rows = df.join(known, F.col(column).cast("string") == F.col("_value"), "left")
            place = F.coalesce("_place", F.lit(self.sizes[column])).cast("double")
            df = self._encoder(column).transform(rows.withColumn(f"{column}_idx", place).drop("_value", "_place"))
        return df

    def _encoder(self, column: str) -> OneHotEncoderModel:
        # The size of the vectors follows from one row with the last place, which has no slot of its own.
        last = self.places[column].sparkSession.range(1).select(F.lit(float(self.sizes[column])).alias(f"{column}_idx"))
        return OneHotEncoder(inputCols=[f"{column}_idx"], outputCols=[f"{column}_vec"], dropLast=True).fit(last)


@dataclass(frozen=True)
class OneHotVectorFit:
    cols: Sequence[str]

    def fit(self, train: DataFrame) -> OneHotVectors:
        """Learn the categories of the columns; they are numbered and stored when this is called."""
        places, sizes = {}, {}
        for column in self.cols:
            values = train.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
            numbers = ordered.numbered(values, [], [F.col("value")], number="_n")
            places[column] = stored(numbers.select("value", (F.col("_n") - 1).alias("place")), "one-hot-places")
            sizes[column] = places[column].count()
        return OneHotVectors(places, sizes)


def one_hot_vector(cols: Sequence[str]) -> OneHotVectorFit:
    """The same coding as sparse vectors ``<col>_vec``, for any number of categories: ``.fit(train).transform(other)``."""
    return OneHotVectorFit(tuple(cols))
