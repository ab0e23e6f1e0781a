"""What several operators share: staging, words, names of helper columns."""

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as a Java and DuckDB pattern: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is ``spark.checkpoint.dir``.  Where that is unset, a local session uses its
    warehouse; a cluster without it is refused, since a local path would lose rows.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{folder.rstrip('/')}/masterloom-llm"


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read back.

    Cuts the lineage: what follows survives the loss of any executor and is not
    computed again.  The files stay until ``discard`` or until the folder is cleared.
    ``codec`` is for wide rows, where the session's own takes more room.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    context = staged.sparkSession.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(staged.staged_at)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(quoted(name))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def uniform(seed: str, *keys: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the keys alone; null keys count.

    The first 13 hexadecimal digits of an MD5, so any engine can repeat it.
    """
    text = F.concat_ws("/", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(1 << 52))


def word_runs(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in runs of about ``size`` bytes, so that memory is bounded."""
    at, end = 0, len(data)
    while at < end:
        stop = at + size
        if stop < end:
            space = SPACE.search(data, stop)
            stop = space.start() if space else end
        yield data[at:stop].split()
        at = stop


SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(lengths: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose lengths sum to about ``most``."""
    begin, total, at = 0, 0, 0
    for at, n in enumerate(lengths):
        if total and total + n > most:
            yield begin, at
            begin, total = at, 0
        total += n
    if total or begin <= at:
        yield begin, at + 1


class Forest:
    """Union-find over the items of one block, joined by arrays of pairs."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def _flatten(self) -> None:
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.parent[a], self.parent[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))
            self._flatten()

    def roots(self) -> np.ndarray:
        """Each item's smallest item that it is joined with."""
        return self.parent
