"""Expressions that are built once and applied to many tables.

Columns name what they read and belong to no table, so the steps of a function are the same for all tables with the same
names and settings. Making them takes a call to the JVM for every operator in them, which is most of what building a
plan costs.
"""

from __future__ import annotations

import functools
import threading
from collections import OrderedDict
from collections.abc import Callable, Hashable

from pyspark import SparkContext
from pyspark.sql import DataFrame

#: Templates kept; the least recently used one goes first.
KEPT = 256

_made: OrderedDict[Hashable, object] = OrderedDict()
_lock = threading.RLock()  # streams build their plans in threads of their own


def template(make: Callable) -> Callable:
    """Keep what ``make`` returns for its arguments, which must be hashable, while the application lasts.

    Functions made for one application hold its accumulators, so another one gets its own.
    """

    @functools.wraps(make)
    def kept(*args: Hashable) -> object:
        context = SparkContext._active_spark_context
        key = (context and context.applicationId, make, args)
        with _lock:
            if key not in _made:
                _made[key] = make(*args)
                while len(_made) > KEPT:
                    _made.popitem(last=False)
            _made.move_to_end(key)
            return _made[key]

    return kept


def staged(df: DataFrame, steps: list[dict], spare: tuple | list = ()) -> DataFrame:
    """Add the columns of each step in turn, then drop the spare ones."""
    for columns in steps:
        df = df.withColumns(columns)
    return df.drop(*spare) if spare else df
