"""A pluggable judge over batches of rows; without one, everything is kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

SNIPPET = 3000


def judged(df: DataFrame, judge: Callable[[list[str]], list[bool | None]] | None = None, text: str = "text", batch: int = 8, snippet: int = SNIPPET) -> DataFrame:
    """Adds ``keep`` and ``judge_error``.  ``judge`` gets up to ``batch`` beginnings of texts, of
    SNIPPET characters as the rule has it (more where ``text`` has something put before them);
    a missing answer, or a failure of the judge, which is told in judge_error, keeps
    the row."""
    if judge is None:
        return df.withColumn("keep", F.lit(True)).withColumn("judge_error", F.lit(None).cast("string"))

    @pandas_udf("keep boolean, judge_error string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            keep, errors = [], []
            for i in range(0, len(series), batch):
                part, error = [x or "" for x in series.iloc[i : i + batch]], None
                try:
                    said = list(judge(part))[: len(part)]
                except Exception as e:  # an unreachable judge rejects nothing
                    said, error = [], f"{type(e).__name__}: {e}"
                keep += [True if x is None else bool(x) for x in said] + [True] * (len(part) - len(said))
                errors += [error] * len(part)
            yield pd.DataFrame({"keep": pd.Series(keep, dtype="bool"), "judge_error": pd.Series(errors, dtype="object")})

    out = df.withColumn("_said", ask(F.substring(text, 1, snippet)))
    return out.withColumn("keep", F.col("_said.keep")).withColumn("judge_error", F.col("_said.judge_error")).drop("_said")
