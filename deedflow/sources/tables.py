"""Tables by name, each read when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from deedflow.sources.schema import TABLES, Table


class LazyTables(dict[str, DataFrame]):
    """``specs`` declares the tables; ``state``, if given, reads what is kept of the keys of some rows."""

    def __init__(
        self,
        read: Callable[[str], DataFrame],
        specs: Mapping[str, Table] = TABLES,
        state: Callable[[str, DataFrame], DataFrame] | None = None,
    ):
        super().__init__()
        self._read = read
        self.specs = specs
        self.state = state

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._read(name)
        return self[name]

    def __or__(self, other: Mapping[str, DataFrame]) -> LazyTables:
        """With some tables in place of its own, which the kept state knows nothing of."""
        made = LazyTables(self._read, self.specs)
        made.update(self)
        made.update(other)
        return made
