"""Columns that are built one time and used again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def once(build: Callable) -> Callable:
    """Build columns that follow from plain settings alone the first time they are asked for.

    Making a column takes several calls to the JVM; a plan of some hundred columns that is
    made for each of many small micro-batches costs more than the work on their rows. Columns
    are not resolved, so they hold for every table and session of a JVM.
    """
    made: dict = {}

    @wraps(build)
    def get(*settings):
        key = (id(SparkContext._gateway), settings)
        if key not in made:
            made[key] = build(*settings)
        return made[key]

    return get


@once
def named(*names: str) -> list[Column]:
    return [F.col(name) for name in names]


@once
def summed(*names: str) -> list[Column]:
    """The sum of each column, under its name."""
    return [F.sum(name).alias(name) for name in names]
