"""Token arrays: encoding with a tokenizer file, pair truncation, masks, padding."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

LEAST_ANSWER = 32
LEAST_RECORD = 4


def encoded(df: DataFrame, text: str, tokenizer_path: str, end_id: int | None = None, most: int | None = None, out: str = "ids") -> DataFrame:
    """Adds each text's ids, the end id behind them, cut to ``most``.  The file is read once
    per worker."""
    @pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tail = [] if end_id is None else [end_id]
        for series in batches:
            found = []
            for i in range(0, len(series), 64):
                found += tokenizer.encode_batch_fast([x or "" for x in series.iloc[i : i + 64]], add_special_tokens=False)
            yield pd.Series([(e.ids + tail)[:most] for e in found])

    return df.withColumn(out, encode(F.col(text)))


def decoded(df: DataFrame, ids: str, tokenizer_path: str, out: str = "decoded") -> DataFrame:
    @pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        for series in batches:
            yield pd.Series([tokenizer.decode([int(i) for i in x], skip_special_tokens=False) for x in series])

    return df.withColumn(out, decode(F.col(ids)))


def fitted(prompt: Column, answer: Column, most: int) -> tuple[Column, Column]:
    """A pair cut to ``most`` ids together: the answer gives way, but keeps LEAST_ANSWER of
    its ids (or all, if fewer) at the prompt's expense."""
    p, a = F.size(prompt), F.size(answer)
    over, room = p + a > most, most - p
    tight = over & (room < LEAST_ANSWER)
    short = F.when(tight, F.slice(prompt, F.lit(1), F.greatest(F.lit(0), most - F.least(F.lit(LEAST_ANSWER), a)))).otherwise(prompt)
    return short, F.when(tight, F.slice(answer, F.lit(1), F.lit(LEAST_ANSWER))).when(over, F.slice(answer, F.lit(1), room)).otherwise(answer)


def record(prompt: Column, answer: Column, end_id: int) -> Column:
    """Struct of ids and mask: 1 under the answer, 0 under the prompt and the end id."""
    ids = F.concat(prompt, answer, F.array(F.lit(end_id)))
    mask = F.concat(F.array_repeat(F.lit(0), F.size(prompt)), F.array_repeat(F.lit(1), F.size(answer)), F.array(F.lit(0)))
    return F.struct(ids.alias("ids"), mask.alias("mask"))


def long_enough(prompt: Column, answer: Column) -> Column:
    return F.size(prompt) + F.size(answer) >= LEAST_RECORD


def prompt_length(mask: Column) -> Column:
    """How many ids stand before the first under the mask."""
    at = F.array_position(mask, 1)
    return F.when(at > 0, at - 1).otherwise(F.size(mask))


def left_padded(df: DataFrame, batch: str, ids: str, pad_id: int) -> DataFrame:
    """Pads each row to the longest of its batch, a bounded group; adds ``padding``."""
    d = df.withColumn("padding", (F.max(F.size(ids)).over(Window.partitionBy(batch)) - F.size(ids)).cast("int"))
    return d.withColumn(ids, F.concat(F.array_repeat(F.lit(pad_id), F.col("padding")), F.col(ids)))
