"""Unicode normal forms, for which Spark has no expression: by Arrow, on distinct texts with other letters than ASCII only."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalised(df: DataFrame, col: str, name: str, form: str = "NFKC") -> DataFrame:
    """FN-16, FN-25: df with column `name`, the normal form of a text column; null stays null.

    ASCII texts are their own normal forms and never leave the JVM.
    """
    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(f"no normal form: {form}")

    @F.pandas_udf("string")
    def normal(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda x: unicodedata.normalize(form, x))

    other = df.where(F.col(col).rlike(r"[^\x00-\x7f]")).select(F.col(col).alias("_text")).distinct()
    other = other.select("_text", normal("_text").alias("_normal"))
    return df.join(other, df[col] == other["_text"], "left").withColumn(name, F.coalesce("_normal", F.col(col))).drop("_text", "_normal")
