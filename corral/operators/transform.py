"""Transformation slot: user steps applied between staging and validation."""

from __future__ import annotations

from typing import Callable, Sequence, Union

from pyspark.sql import DataFrame

Step = Union[Callable[[DataFrame], DataFrame], str]


def apply_transformations(df: DataFrame, steps: Sequence[Step] = ()) -> DataFrame:
    """Apply each step in order.  A step is a function ``DataFrame ->
    DataFrame`` or SQL text that reads the current frame as ``{src}``.
    No steps: the frame is returned unchanged."""
    out = df
    for step in steps:
        if isinstance(step, str):
            out = out.sparkSession.sql(step, src=out)
        else:
            out = out.transform(step)
    return out
