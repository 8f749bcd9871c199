"""Adapters for what lies outside Spark: text detection and recognition, neural forecasts (G-08, Y-05)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class ModelProvider(Protocol):
    """What a model tier must offer; one is made lazily in each Python worker."""

    def recognise(self, contents: list[bytes]) -> list[tuple[str, float]]: ...


class FixtureProvider:
    """Reads nothing: every crop's text is its bytes, at full confidence."""

    def recognise(self, contents: list[bytes]) -> list[tuple[str, float]]:
        return [(c.decode("utf-8", "replace"), 1.0) for c in contents]


def recognise(crops: DataFrame, make: Callable[[], ModelProvider] = FixtureProvider, batch: int = 64) -> DataFrame:
    """(path, text, conf) of crops (path, content), in batches of `batch`; filters belong before this call."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                got = provider.recognise([bytes(c) for c in part["content"]])
                yield pd.DataFrame({"path": part["path"].to_numpy(), "text": [t for t, _ in got], "conf": [c for _, c in got]})

    return crops.select("path", "content").mapInPandas(run, "path string, text string, conf double")
