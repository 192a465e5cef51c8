"""Helpers shared by the text operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.session import scratch_path


# Rows of text go to Python workers in batches of this size at most, so that
# a worker's memory does not depend on how long the texts are.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def bound_batches(spark: SparkSession) -> None:
    """Set the batch limits above for this session where they are unset."""
    for key, (default, value) in BATCH.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back:
    the lineage is cut and a lost executor cannot change what later steps
    see (also used where a step is not deterministic across retries)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_hash(c: Column, *more: Column) -> Column:
    """Non-negative 63-bit hash for bucketing."""
    return F.xxhash64(c, *more).bitwiseAND(F.lit((1 << 63) - 1))


_held: list[tuple[str, Callable[[], None]]] = []


def hold_alone(name: str, forget: Callable[[], None]) -> None:
    """Called by a Python worker's large memory of words before use: the
    memory that another operator left in a reused worker is dropped."""
    if _held and _held[0][0] != name:
        _held.pop()[1]()
    if not _held:
        _held.append((name, forget))


def utf8_length(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def by_bytes(texts: list[str], limit: int, size: Callable[[str], int] = len) -> Iterator[list[str]]:
    """Consecutive slices of ``texts`` of about ``limit`` each in ``size``
    (characters, or bytes with :func:`utf8_length`); a longer text is a slice
    of its own."""
    part: list[str] = []
    total = 0
    for t in texts:
        n = size(t)
        if part and total + n > limit:
            yield part
            part, total = [], 0
        part.append(t)
        total += n
    if part:
        yield part
