"""Models that may fail on some of their rows."""

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import PythonEvalType

# Sent along with each job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ITERATES = (PythonEvalType.SQL_SCALAR_PANDAS_ITER_UDF, PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF)
_ARROW = (PythonEvalType.SQL_SCALAR_ARROW_UDF, PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF)
ERROR_LETTERS = 500


class _Running:
    """A model as a function of one batch. An iterating model keeps its weights until it fails."""

    def __init__(self, func, iterates: bool, arrow: bool):
        self.func, self.iterates, self.arrow = func, iterates, arrow
        self.results = self.given = None

    def _batches(self):
        while True:
            yield self.given

    def __call__(self, rows: pd.Series) -> list:
        self.given = pa.Array.from_pandas(rows) if self.arrow else rows
        if not self.iterates:
            made = self.func(self.given)
        else:
            if self.results is None:
                self.results = iter(self.func(self._batches()))
            try:
                made = next(self.results)
            except BaseException:
                self.results = None
                raise
        made = made.to_pylist() if isinstance(made, (pa.Array, pa.ChunkedArray)) else list(made)
        if len(made) != len(rows):
            raise ValueError(f"{len(made)} results for {len(rows)} rows")
        return made


def attempt(run, rows: pd.Series) -> tuple[list, list]:
    """Values and errors of the rows: a batch that fails is halved until single rows are left."""
    try:
        return run(rows), [None] * len(rows)
    except Exception as error:
        if len(rows) == 1:
            return [None], [f"{type(error).__name__}: {error}"[:ERROR_LETTERS]]
    half = len(rows) // 2
    parts = [attempt(run, part.reset_index(drop=True)) for part in (rows[:half], rows[half:])]
    return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]


def guard(model):
    """A pandas UDF like `model` that gives (value, error) for each row, one of them null.

    A row that the model raises on has its error as text and ends nothing; all others have the
    value they would have had. `model` is a pandas or Arrow UDF of one column, iterating (a
    batch out for each batch in) or not.
    """
    func, kind = model.func, model.evalType
    result = T.StructType([T.StructField("value", model.returnType), T.StructField("error", T.StringType())])

    @F.pandas_udf(result)
    def guarded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        run = _Running(func, kind in _ITERATES, kind in _ARROW)
        for rows in batches:
            values, errors = attempt(run, rows.reset_index(drop=True)) if len(rows) else ([], [])
            yield pd.DataFrame({"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)})

    return guarded
