"""Shared plumbing: work folder, materialised tables, cached piece encoding."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from itertools import chain, compress, repeat
from operator import is_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import shared_folder

#: Characters of text that are tokenised at a time; bounds the worker's lists.
GROUP_CHARS = 1 << 20
#: Distinct pieces that a worker remembers before it starts afresh.
CACHE_PIECES = 1 << 18

_BEFORE_SPACE = re.compile(r"\s ")


def work_root(spark: SparkSession) -> str:
    """A folder of ours in the one that all nodes share."""
    return f"{shared_folder(spark).rstrip('/')}/corpusmill"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from the
    files, so a lost executor costs at most the stage that was running."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """As ``materialize``, in buckets of a column: a join on it moves the other side only."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"corpusmill_{path.rsplit('-', 1)[-1]}"
    df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(table)
    return spark.table(table)


#: Bytes of rows that a Python worker is sent at a time, where the session sets nothing.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Texts are long: by Spark's default a batch of rows has 64 MB, in the executor's memory
    twice and in the worker's once.  Any other setting stays as it is."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64MB"):
        spark.conf.set(key, str(BATCH_BYTES))


def purge(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote in this session's folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(work_root(spark))
    path.getFileSystem(conf).delete(path, True)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; extra columns, whatever their names, never get further.  What
    is done with them gets small batches."""
    small_batches(df.sparkSession)
    return df.select(*[df[f"`{n}`"] for n in names])


def parallel(df: DataFrame, least: int | None = None) -> DataFrame:
    """Spread a small table over the cores; a table with enough partitions stays as it is."""
    least = least or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function that gives its memory back at the end: workers live on, and what they
    keep counts against the executor while later stages run."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return wrapped


def settle(spark: SparkSession) -> int:
    """Lets executors collect their garbage: a heap that one stage has filled is given back only
    by a full collection, which a JVM with room left never starts, while the workers of the
    next stage stand beside it.  The number of tasks that had one."""
    n = spark.sparkContext.defaultParallelism
    return spark.range(0, n, 1, n).filter(F.expr("reflect('java.lang.System', 'gc') is not null")).count()


def groups(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Consecutive texts (null: empty) in lists of about GROUP_CHARS characters."""
    out, chars = [], 0
    for t in texts:
        t = t or ""
        out.append(t)
        chars += len(t) + 64
        if chars >= GROUP_CHARS:
            yield out
            out, chars = [], 0
    if out:
        yield out


def strings(column: pa.Array) -> Iterator[str | None]:
    """The column's values one by one, so that one batch never exists twice as a whole."""
    for value in column:
        yield value.as_py()


class PieceEncoder:
    """Encodes texts by units that begin at a space.

    The pattern that splits text before the merges lets a match begin with at most one
    space, and never look past a space that follows a non-space.  So where no white space
    stands directly before a space, cutting a text before each of its spaces changes no
    token, and each distinct unit is encoded once.  A unit of letters is one match; one
    mark of MARKS behind it is another.  Other texts and units are encoded as they are.

    ``matches`` encodes strings that are one match each, ``texts`` any strings; both give
    packed ids.  ``whole`` tells of texts that must not be cut.
    """

    MARKS = frozenset(".,;:!?")

    def __init__(self, matches: Callable[[list[str]], list[bytes]], texts: Callable[[list[str]], list[bytes]], whole: Callable[[str], bool] | None = None, remembered: int = CACHE_PIECES):
        self.remembered = remembered
        self.matches, self.texts, self.whole = matches, texts, whole
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        alone = [*sorted(self.MARKS), "\n"]
        self.marks = dict(zip(alone, matches(alone), strict=True))

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """The memory, now with all wanted pieces, which it lacks."""
        young, old = self.young, self.old
        words, marked, rest, broken = [], [], [], []
        for p in wanted:
            if (ids := old.get(p)) is not None:
                young[p] = ids
            elif p.isalpha():
                words.append(p)
            elif p[-1:] in self.MARKS and p[:-1].isalpha():
                marked.append(p)
            else:
                left, line, right = p.partition("\n")
                (broken if line and self._simple(left) and self._simple(right) else rest).append(p)
        more = {p[:-1] for p in marked}
        for p in broken:  # a line break between non-blanks is a match of its own, and right has no space before it
            left, _, right = p.partition("\n")
            more.add(left if left.isalpha() else left[:-1])
            more.add("\n" + (right if right.isalpha() else right[:-1]))
        words.extend(more.difference(young, words))
        young.update(zip(words, self.matches([p[1:] if p[0] == "\n" else " " + p for p in words]), strict=True))
        for p in marked:
            young[p] = young[p[:-1]] + self.marks[p[-1]]
        for p in broken:
            left, _, right = p.partition("\n")
            first = young[left] if left.isalpha() else young[left[:-1]] + self.marks[left[-1]]
            second = young["\n" + right] if right.isalpha() else young["\n" + right[:-1]] + self.marks[right[-1]]
            young[p] = first + self.marks["\n"] + second
        if rest:
            young.update(zip(rest, self.texts([" " + p for p in rest]), strict=True))
        return young

    def _simple(self, p: str) -> bool:
        return p.isalpha() or (p[-1:] in self.MARKS and p[:-1].isalpha())

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [None if _BEFORE_SPACE.search(t) or (self.whole and self.whole(t)) else t.split(" ") for t in texts]
        heads = self.texts([t if pieces is None else pieces.pop(0) for t, pieces in zip(texts, split, strict=True)])
        if len(self.young) > self.remembered:  # what wasn't met for long is forgotten
            self.young, self.old = {}, self.young
        pieces = list(chain.from_iterable(filter(None, split)))
        ids = list(map(self.young.get, pieces))
        missing = list(compress(range(len(pieces)), map(is_, ids, repeat(None))))
        if missing:
            known = self._learn({pieces[i] for i in missing})
            for i in missing:
                ids[i] = known[pieces[i]]
        out, at = [], 0
        for h, p in zip(heads, split, strict=True):
            n = len(p) if p else 0
            out.append(h + b"".join(ids[at : at + n]) if n else h)
            at += n
        return out

    def forget(self) -> None:
        """Between tasks: most of what is remembered is rare, and idle workers should be small."""
        self.young, self.old = {}, {}
