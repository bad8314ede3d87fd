"""Small tables and plain re-computations for the tests."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[str | None], clash: str = "") -> DataFrame:
    """Documents numbered from 0, with extra columns of the names in ``clash``."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, TEXTS)
    for name in clash.split():
        df = df.selectExpr("*", f"'extra' AS {name}")
    return df


def crc(key: object) -> int:
    return zlib.crc32(str(key).encode())


class Union:
    """Components by the smallest member."""

    def __init__(self, items) -> None:
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a, b) -> None:
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a
