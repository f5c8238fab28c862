"""Continuous ingestion: filters, exact duplicates and windows on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators import filters


def deduplicated(stream: DataFrame, text: str = "text", delay: str | None = None, at: str = "ts") -> DataFrame:
    """The first row of each text; with ``delay``, state older than the watermark goes."""
    keyed = stream.withColumn("hash", F.sha1(F.col(text).cast("binary")))
    if delay:
        return keyed.withWatermark(at, delay).dropDuplicatesWithinWatermark(["hash"])
    return keyed.dropDuplicates(["hash"])


def filtered(stream: DataFrame, text: str = "text", least: int = 500) -> DataFrame:
    return stream.withColumn("reason", filters.prose_reason(F.col(text), least)).filter("reason is null").drop("reason")


def per_window(events: DataFrame, width: str, delay: str, at: str = "ts", by: str = "event_type") -> DataFrame:
    """Counts and sums by window and kind, closed by the watermark."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write all there is now, resuming where the last run ended."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def topped_up(fetch, write, budget: int, most_idle: int = 5) -> int:
    """Rounds of ``fetch(round)`` (a DataFrame with a column ``bytes``, or None) written by
    ``write(df)`` until the budget is reached, or until so many rounds in a row brought nothing.
    Gives the bytes that were written."""
    total = idle = k = 0
    while total < budget and idle < most_idle:
        rows = fetch(k)
        got = 0 if rows is None else rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first().n
        if got:
            write(rows)
        total, idle, k = total + got, 0 if got else idle + 1, k + 1
    return total


def in_batches(stream: DataFrame, handle, path: str, checkpoint: str, most_rows: int = 8) -> None:
    """Runs ``handle`` (list of rows as dicts to list of rows) over all there is, at most so many
    rows at a time, and writes what it gives.  A micro-batch bounds what is under way; its files
    per trigger are the source's setting."""
    schema = stream.schema

    def run(frames):
        import pandas as pd

        for frame in frames:
            for i in range(0, len(frame), most_rows):
                yield pd.DataFrame(handle(frame.iloc[i : i + most_rows].to_dict("records")), columns=schema.names)

    run_available(stream.mapInPandas(run, schema), path, checkpoint)


def near_deduplicated(stream: DataFrame, text: str = "text", most: int = 200_000) -> DataFrame:
    """Rows of which no MinHash band was among the last ``most`` ones of their bucket; a bucket's
    state forgets the oldest first.  Rows are dealt by their first band, so copies that differ
    there do not meet here; the batch operators find them."""
    import pandas as pd

    from corpusmill.operators import dedup, sketches

    signed = dedup.with_shingles(stream, text).filter("size(shingles) > 0").withColumn("_h", sketches.minhashes(F.col("shingles")))
    keys = F.array(*[F.xxhash64(F.lit(b), *[F.get("_h", F.lit(b * sketches.ROWS + r)) for r in range(sketches.ROWS)]) for b in range(sketches.BANDS)])
    # A row goes to the bucket of its first band, with the rest of them along.
    placed = signed.withColumn("bands", keys).drop("shingles", "_h").withColumn("bucket", F.pmod(F.col("bands")[0], F.lit(64)))
    schema = placed.schema

    def update(key, frames, state):
        seen = list(state.get[0]) if state.exists else []
        known, out = set(seen), []
        for frame in frames:
            for row in frame.to_dict("records"):
                bands = [int(x) for x in row["bands"]]
                if not known.intersection(bands):
                    out.append(row)
                    seen += bands
                    known.update(bands)
        state.update((seen[-most:],))
        yield pd.DataFrame(out, columns=schema.names)

    return placed.groupBy("bucket").applyInPandasWithState(update, schema, "seen array<long>", "append", "NoTimeout")
