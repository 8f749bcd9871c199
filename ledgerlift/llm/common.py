"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerlift.shared import cut_lineage, shared_folder, written

__all__ = ["carried_id", "cut_lineage", "groups", "shared_folder", "table", "whole_text", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(text, F.lit(""))


def carried_id(df: DataFrame, name: str) -> tuple[Column, str]:
    """An id column as it goes through pandas, and its type there.

    Integers go as text: a null among them would turn all ids of its batch into floats, which are exact only to 2**53.
    """
    kind = df.schema[name].dataType
    return (F.col(name).cast("string"), "string") if isinstance(kind, IntegralType) else (F.col(name), kind.simpleString())


def groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Cut the batches of a partition that is sorted by `key` at its changes; a group may span batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1][key].iloc[-1] != keys[0]:
            yield pd.concat(held, ignore_index=True)
            held = []
        starts = [0, *cuts.tolist()]
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            part = batch.iloc[start:end]
            if held:
                part, held = pd.concat([*held, part], ignore_index=True), []
            yield part
        held.append(batch.iloc[starts[-1] :])
    if held:
        yield pd.concat(held, ignore_index=True)
