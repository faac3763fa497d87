"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as Spark reads it (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared folder."""
    return f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: the
    lineage ends there and a lost executor recomputes nothing before it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(total: int, per_partition: int) -> int:
    """How many partitions hold ``total`` at ``per_partition`` each."""
    return max(1, -(-int(total or 0) // per_partition))


def utf8_bytes(text: Column) -> Column:
    """Length of the text in UTF-8; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


#: What a word of ASCII letters, digits and all else beyond ASCII is made of; A-Z
#: become small, every other byte a blank.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def ascii_words(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, in runs from about ``size`` bytes each, so
    that a very long text never stands in memory as one list."""
    plain, begin = data.translate(_WORD_BYTES), 0
    while begin < len(plain):
        end = plain.find(b" ", begin + size)
        yield plain[begin:end if end >= 0 else len(plain)].split()
        begin = end if end >= 0 else len(plain)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column is called so in any case."""
    own = {c.lower() for c in taken}
    while name.lower() in own:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as Spark's parsers read it, dots and back quotes included."""
    return "`" + name.replace("`", "``") + "`"


_CACHES: dict[str, Callable[[], None]] = {}


def take_over(owner: str, forget: Callable[[], None]) -> None:
    """Called by a task before it fills its process's cache: a Python worker that
    ran another operator's tasks before gives up what those remembered. ``forget``
    is a function of a module: a bound method would reach the worker as a copy."""
    others = [n for n in _CACHES if n != owner]
    for name in others:
        _CACHES.pop(name)()
    _CACHES[owner] = forget
    if others:
        gc.collect()
        give_back()


def give_back() -> None:
    """Returns freed memory to the system: Arrow and the C library keep it for
    later use, which an idle worker beside a busy JVM does not have."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def as_task(owner: str, forget: Callable[[], None], run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``: takes over its worker's memory and gives back
    what it has freed at its end."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over(owner, forget)
        yield from run(batches)
        give_back()

    return task


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, whole texts of which go to Python workers in batches of 4 MB, unless
    the session has a size of its own: Spark's 64 MB stand several times over in
    the JVM and the worker of every running task."""
    conf = df.sparkSession.conf
    if _BATCH_BYTES not in conf.getAll:
        conf.set(_BATCH_BYTES, "4m")
    return df


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1 ... whatever they were called, and the new name
    of each (the first, where a name repeats)."""
    names: dict[str, str] = {}
    for i, c in enumerate(df.columns):
        names.setdefault(c, f"c{i}")
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), names


def arrow_mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name, in and out; columns go by position."""
    inner = StructType([StructField(f"o{i}", f.dataType) for i, f in enumerate(schema.fields)])
    names = inner.names

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    return numbered(df)[0].mapInArrow(renamed, inner).toDF(*schema.names)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(weights: list[int], limit: int):
    """Cut positions of consecutive runs whose summed weight stays near
    ``limit``; an item heavier than that gets a run of its own."""
    begin = acc = 0
    for i, w in enumerate(weights):
        if i > begin and acc + w > limit:
            yield begin, i
            begin, acc = i, 0
        acc += w
    if begin < len(weights):
        yield begin, len(weights)
