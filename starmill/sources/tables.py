"""Reading source tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession


class OpenOnUse(Mapping):
    """Named DataFrames, each put together when it is first asked for."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._openers[name]()
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> OpenOnUse:
    return OpenOnUse({name: partial(read_table, spark, folder, name) for name in names})
