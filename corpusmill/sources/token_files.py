"""A data source for flat little-endian token files (.bin), read in slices.

``spark.dataSource.register(TokenFiles)``, then
``spark.read.format("tokens").option("dtype", "uint16").load(path)``: rows (file, start, ids).
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

WIDTH = {"uint8": 1, "uint16": 2, "uint32": 4}


def dtype_for(vocab_size: int) -> str:
    return "uint16" if vocab_size <= 65536 else "uint32"


class _Slice(InputPartition):
    def __init__(self, path: str, start: int, count: int):
        self.path, self.start, self.count = path, start, count


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.dtype = options["path"], options.get("dtype", "uint16")
        self.slice = int(options.get("sliceids", 1 << 20))

    def partitions(self) -> list[_Slice]:
        out = []
        paths = sorted(glob.glob(f"{self.path}/*.bin")) if os.path.isdir(self.path) else [self.path]
        for p in paths:
            n = os.path.getsize(p) // WIDTH[self.dtype]
            out += [_Slice(p, a, min(self.slice, n - a)) for a in range(0, n, self.slice)]
        return out

    def read(self, part: _Slice) -> Iterator[tuple]:
        import numpy as np

        ids = np.fromfile(part.path, self.dtype, part.count, offset=part.start * WIDTH[self.dtype])
        yield os.path.basename(part.path), part.start, ids.astype("int64").tolist()


class TokenFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tokens"

    def schema(self) -> str:
        return "file string, start long, ids array<long>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def write(pieces, path: str, vocab_size: int) -> int:
    """Write pieces (offset, ids), which tile the stream, as one file of a folder that is mounted
    on all nodes: each task writes its pieces at their places.  Gives the number of ids.  Blocks
    of ``packed.write`` go through Spark's committer instead, to any store."""
    import numpy as np
    from pyspark.sql import functions as F

    dtype = dtype_for(vocab_size)
    total = int(pieces.agg(F.max(F.col("offset") + F.size("ids"))).first()[0] or 0)
    with open(path, "wb") as f:
        f.truncate(total * WIDTH[dtype])

    def put(rows) -> None:
        with open(path, "r+b") as f:
            for r in rows:
                f.seek(r.offset * WIDTH[dtype])
                f.write(np.array(r.ids, dtype).tobytes())

    pieces.select("offset", "ids").foreachPartition(put)
    return total
