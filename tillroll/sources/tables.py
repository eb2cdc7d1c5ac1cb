"""The named table set every operator works on."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tillroll.model import TABLES


class Tables:
    """Eight retail tables by name; a table is built when it is first asked for."""

    def __init__(self, builders: Mapping[str, DataFrame | Callable[[Tables], DataFrame]]):
        unknown = set(builders) - set(TABLES)
        if unknown:
            raise ValueError(f"not a table of the model: {sorted(unknown)}")
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            source = self._builders[name]
            self._built[name] = source if isinstance(source, DataFrame) else source(self)
        return self._built[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        return self[name]

    def __iter__(self):
        return (name for name in TABLES if name in self._builders)

    def replaced(self, **tables: DataFrame) -> Tables:
        """The same set with some tables exchanged."""
        return Tables({**{name: self[name] for name in self}, **tables})
