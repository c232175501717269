"""Columns by name, whatever characters the name has, and names that are not taken."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def quoted(name: str) -> str:
    """``name`` as it stands in an expression."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str, of: str | None = None) -> Column:
    """The column called ``name``, or the field of that name of the struct ``of``."""
    return F.col(quoted(name) if of is None else f"{quoted(of)}.{quoted(name)}")


def columns(names: Iterable[str]) -> list[Column]:
    return [column(n) for n in names]


def fresh(name: str, *taken: Iterable[str]) -> str:
    """``name``, lengthened until none of the ``taken`` names equals it."""
    used = {t.lower() for names in taken for t in names}
    while name.lower() in used:
        name += "_"
    return name


class Plain:
    """A DataFrame under plain column names, so that an operator's own names clash with none of its columns."""

    def __init__(self, df: DataFrame, prefix: str = "c"):
        self.names = df.columns
        self._prefix = prefix
        self._places = {n.lower(): i for i, n in enumerate(self.names)}
        self.plain = [f"{prefix}{i}" for i in range(len(self.names))]
        self.df = df.toDF(*self.plain)

    def of(self, name: str) -> str:
        """The plain name of a column; names are found as Spark finds them, whatever their case."""
        if name.lower() not in self._places:
            raise ValueError(f"there is no column {name} among {self.names}")
        return self.plain[self._places[name.lower()]]

    def all_of(self, names: Iterable[str]) -> list[str]:
        return [self.of(n) for n in names]

    def back(self, df: DataFrame, *added: str) -> DataFrame:
        """``df``, which has the plain columns in order and then others, under its former names and ``added``."""
        return df.toDF(*self.names, *added)
