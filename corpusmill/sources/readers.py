"""Folders of raw files, catalogs of datasets, and samples of either."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.sources import tables

#: JSON files above this many bytes are left out; those with one record a line are split.
MOST_JSON_BYTES = 300 << 20


def worker_share(files: DataFrame, worker: int, workers: int, path: str = "path") -> DataFrame:
    """The files whose place in order of their names, those without one last, falls to a worker;
    with their place.  Each row is a file, whether its name occurs again or not."""
    from corpusmill.operators import packing

    placed = packing.running_offset(files.withColumn("_none", F.col(path).isNull()), ["_none", path], F.lit(1))
    return placed.filter(F.col("offset") % workers == worker).withColumnRenamed("offset", "place").drop("_none")


def shuffled(files: DataFrame, seed: int = 42, path: str = "path") -> DataFrame:
    """Files in an order by hash, the same for one seed."""
    return files.orderBy(F.xxhash64(path, F.lit(seed)), path)


def folder_rows(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """Records of all files under a folder: csv and tsv by row, jsonl by line, json by entry, txt
    as a whole.  Malformed rows are skipped."""
    def read(glob: str, load) -> DataFrame | None:
        r = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        files = r.format("binaryFile").load(folder).select("path", "length")
        if files.isEmpty():
            return None
        return load(r)

    csv = lambda sep: lambda r: r.option("header", "true").option("sep", sep).option("mode", "DROPMALFORMED").option("multiLine", "true").option("escape", '"').csv(folder)
    found = [
        read("*.csv", csv(",")),
        read("*.tsv", csv("\t")),
        read("*.jsonl", lambda r: r.option("mode", "DROPMALFORMED").json(folder)),
        read("*.json", lambda r: r.option("multiLine", "true").option("mode", "DROPMALFORMED").json(folder).filter(F.col("_metadata.file_size") <= MOST_JSON_BYTES)),
        read("*.txt", lambda r: r.text(folder, wholetext=True).withColumnRenamed("value", "text")),
    ]
    out = [tables.as_records(df, source) for df in found if df is not None and tables.suitable(df)]
    rows = spark.createDataFrame([], "text string, prompt string, answer string, source string")
    for df in out:
        rows = rows.unionByName(df)
    return rows.filter(F.coalesce(F.col("text"), F.lit("")) != "")


def folder_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """One row: files and bytes under a folder, whatever they hold."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def streamed(df: DataFrame, config: str, split: str, order: str, most: int, prefer: tuple[str, ...] = ("train", "test", "validation")) -> DataFrame:
    """Rows as a hub's stream gives them: of each configuration the first split there is by
    preference, at most its even share of ``most``, and no more than ``most`` in all."""
    rank = F.coalesce(*[F.when(F.col(split) == s, i) for i, s in enumerate(prefer)], F.lit(len(prefer)))
    first = df.groupBy(config).agg(F.min(rank).alias("_best"))
    rows = df.withColumn("_rank", rank).join(F.broadcast(first), config).filter("_rank = _best").drop("_rank", "_best")  # a row per configuration
    return tables.capped(rows, config, order, most).orderBy(config, order).limit(most)


def discovered(catalog: DataFrame, keywords: list[str], blocked: list[str], each: int, most: int) -> DataFrame:
    """name, keyword: datasets whose name has a keyword, the most downloaded first; merged in the
    order of the keywords, the first sighting wins, blocked ones do not count."""
    low = F.lower("name")
    hits = catalog.select("name", "downloads", F.explode(F.array(*[F.when(F.contains(low, F.lit(k.lower())), F.struct(F.lit(i).alias("at"), F.lit(k).alias("keyword"))) for i, k in enumerate(keywords)])).alias("k")).filter("k is not null").select("name", "downloads", "k.at", "k.keyword")
    ranked = hits.withColumn("r", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("downloads"), "name"))).filter(F.col("r") <= each)
    first = ranked.filter(~F.col("name").isin(blocked) if blocked else F.lit(True)).groupBy("name").agg(F.min(F.struct("at", "r", "keyword")).alias("k"))
    return first.orderBy("k.at", "k.r").limit(most).select("name", "k.keyword")


def configurations(df: DataFrame, config: str = "config") -> DataFrame:
    """Distinct configurations; one null row where there are none."""
    found = df.select(config).filter(F.col(config).isNotNull()).distinct()
    return found if not found.isEmpty() else df.sparkSession.createDataFrame([(None,)], f"{config} string")


def sample(df: DataFrame, order: str, n: int = 12) -> DataFrame:
    """The first rows, columns by name."""
    return df.orderBy(order).limit(n).select(*sorted(df.columns))


def prompts(df: DataFrame) -> DataFrame:
    """prompt and answer of rows that have both."""
    filled = lambda c: X.strip(F.coalesce(F.col(c), F.lit(""))) != ""
    return df.filter(filled("prompt") & filled("answer")).select(X.strip(F.col("prompt")).alias("prompt"), X.strip(F.col("answer")).alias("answer"))


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Adds batch and slot, in order."""
    from corpusmill.operators import packing

    o = packing.running_offset(df, [order], F.lit(1))
    return o.withColumn("batch", F.floor(F.col("offset") / size)).withColumn("slot", F.col("offset") % size).drop("offset")


def hinted(df: DataFrame, mapper, dataset: str) -> dict[str, str]:
    """A mapper's hints (dataset, columns, first row) for a table, asked once; those that name no
    string column are left out."""
    first = df.limit(1).collect()
    said = mapper(dataset, df.columns, first[0].asDict() if first else {}) or {}
    kinds = {c.lower(): k for c, k in df.dtypes}
    return {k: v for k, v in said.items() if kinds.get(str(v).lower()) == "string"}


def json_line(*columns: str | Column) -> Column:
    """A record as the line a shard file gets."""
    return F.concat(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), F.lit("\n"))


def next_shards(spark: SparkSession, folder: str, by: str) -> dict[str, int]:
    """The number behind the highest shard of each group in a folder that json shards are in."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return {}
    found = spark.read.json(folder)
    if by not in found.columns or "shard" not in found.columns:
        return {}
    return {r[0]: r[1] + 1 for r in found.groupBy(by).agg(F.max("shard").cast("long")).collect()}  # a row per group


def write_shards(df: DataFrame, folder: str, by: str, order: str, most: int) -> None:
    """JSON shards of at most ``most`` bytes by group, numbered behind those that are there; a
    shard is a folder, and a longer record has one of its own."""
    from corpusmill.operators import packing

    size = F.octet_length(json_line(*[c for c in df.columns if c != by]))
    numbered = packing.assign_shards(df, by, order, size, most, next_shards(df.sparkSession, folder, by))
    numbered.repartition(by, "shard").sortWithinPartitions(order).write.partitionBy(by, "shard").mode("append").json(folder)
