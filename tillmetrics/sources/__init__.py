"""Readers and writers for the five tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class TableSet(Mapping[str, DataFrame]):
    """Tables by name, each read when first asked for."""

    def __init__(self, readers: dict[str, Callable[[], DataFrame]]):
        self._readers = readers
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._readers[name]()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._readers)

    def __len__(self) -> int:
        return len(self._readers)
