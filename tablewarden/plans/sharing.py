"""How an analysis treats a relation that several of its sections read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tablewarden.state.store import cut_lineage

# Called with the section's name and its relation.
Share = Callable[[str, DataFrame], DataFrame]


def as_is(name: str, df: DataFrame) -> DataFrame:
    """Leave it lazy: right when only one section is asked for."""
    return df


def materialise(name: str, df: DataFrame) -> DataFrame:
    """Write it once: right for a nightly run, which reads every section."""
    return cut_lineage(df)


def materialise_only(*names: str) -> Share:
    """Write the named relations only: right when a few sections are asked for."""

    def share(name: str, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if name in names else df

    return share
