"""A fold of each key's rows in order, with the user's own function, in batch.

The streaming form is :func:`eventmill.streaming.jobs.fold_stream`; both take the same functions.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Start = Callable[[tuple], object]
Step = Callable[[tuple, object, pd.DataFrame], tuple[object, pd.DataFrame]]


def by_value(function: Callable) -> bytes:
    """A user's function as bytes, with the rest of its module as far as it uses it.

    A worker has the installed packages and this one, but not the module a user's function stands
    in, so that module must not be sent as a mere name.
    """
    module = sys.modules.get(getattr(function, "__module__", None) or "")
    known = cloudpickle.list_registry_pickle_by_value()
    if module is None or module.__name__ == "__main__" or module.__name__ in known:
        return cloudpickle.dumps(function)
    cloudpickle.register_pickle_by_value(module)
    try:
        return cloudpickle.dumps(function)
    finally:
        cloudpickle.unregister_pickle_by_value(module)


def fold_in_order(
    df: DataFrame, keys: Sequence[str], seq: str, start: Start, step: Step, schema: str
) -> DataFrame:
    """Hand each key's rows, in ``seq`` order, to ``step``.

    ``start(key)`` gives the first state of a key; ``step(key, state, rows)`` the state after a
    chunk of consecutive rows and the rows to put out. Rows are streamed: a key of any size needs
    the memory of a chunk and of its state. Rows with a NULL key are folded together. The functions
    are sent to the workers by value.
    """
    names = list(keys)
    code = by_value(start), by_value(step)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, step = map(cloudpickle.loads, code)
        current, state = None, None
        for batch in batches:
            if batch.empty:
                continue
            number = (batch[names] != batch[names].shift()).any(axis=1)
            number &= ~(batch[names].isna() & batch[names].shift().isna()).all(axis=1)
            for _, rows in batch.groupby(number.cumsum(), sort=False):
                key = tuple(None if pd.isna(v) else v for v in rows[names].iloc[0])
                if current is None or key != current:
                    current, state = key, start(key)
                state, out = step(key, state, rows)
                yield out

    ordered = df.repartition(*names).sortWithinPartitions(*names, F.col(seq).asc_nulls_first())
    return ordered.mapInPandas(run, schema)
