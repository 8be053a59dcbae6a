"""Results of a text beside its row: only the text goes through Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def beside_text(docs: DataFrame, columns: list[Column], text_col: str,
                run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``columns`` and the fields of ``schema``, which ``run`` gives for frames with one column ``_text``.

    The columns stay in the JVM, so ids beside NULLs, times of any year and nested values are not changed.  ``run``
    has to keep the number and the order of rows."""

    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        frames = (part.rename("_text").to_frame().reset_index(drop=True) for part in parts)
        for out in run(frames):
            yield out.drop(columns="_text", errors="ignore").reset_index(drop=True)

    # as if not deterministic: a filter on the result must not run it a second time
    found = F.pandas_udf(texts, schema).asNondeterministic()
    named = [c.alias(f"_c{i}") for i, c in enumerate(columns)]
    out = docs.select(*named, found(F.col(f"`{text_col}`").cast("string")).alias("_found"))
    names = docs.select(*columns).columns
    return out.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)], "_found.*")


def identity(docs: DataFrame, id_col: str, keep: list[str] | None) -> Column:
    """The id column, or a struct ``kept`` of the columns that are kept."""
    if keep is None:
        return F.col(f"`{id_col}`").alias(id_col)
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("kept")
