"""What the text operators share: reading tables, written intermediates, column-wise Arrow maps."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

# word of the contracts: a run of bytes other than space and tab .. carriage return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: a cut that outlives executors. Rows of
    many MB need ``rows_per_file``: Parquet is read thousands of rows of a file at a time."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns of these names, in any letter case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def prefixed(fields: T.StructType, prefix: str) -> T.StructType:
    return T.StructType([T.StructField(prefix + f.name, f.dataType, f.nullable) for f in fields])


def append_columns(df: DataFrame, fn: Callable, inputs: Sequence[str],
                   outputs: T.StructType, owner: str = "") -> DataFrame:
    """``df`` with the columns that ``fn`` makes from the input columns of each Arrow batch. ``owner``
    names what ``fn`` keeps in the Python worker (see ``held``).

    ``fn`` takes one Arrow array per input and returns one sequence per output field. A column
    that ``df`` already has under an output's name is replaced.
    """
    kept = without(df, outputs.names)
    missing = [c for c in inputs if c.lower() not in {k.lower() for k in kept.columns}]
    # an input that is also an output's name travels under another name
    extra = {c: f"__in_{i}" for i, c in enumerate(missing)}
    source = df.select(*[F.col(f"`{c}`") for c in kept.columns],
                       *[F.col(f"`{c}`").alias(a) for c, a in extra.items()])
    names = [extra.get(c, c) for c in inputs]
    n_kept = len(kept.columns)
    schema = T.StructType(kept.schema.fields + outputs.fields)

    def run(batches):
        types = None
        for batch in batches:
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_type
                types = [to_arrow_type(f.dataType) for f in outputs.fields]
            lower = [n.lower() for n in batch.schema.names]
            made = fn(*[batch.column(lower.index(n.lower())) for n in names])
            cols = list(batch.columns[:n_kept]) + [
                m if isinstance(m, pa.Array) else pa.array(m, type=t) for m, t in zip(made, types)]
            fields = [batch.schema.field(i) for i in range(n_kept)] + [
                pa.field(f.name, c.type) for f, c in zip(outputs.fields, cols[n_kept:])]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(fields))

    return source.mapInArrow(trimmed(run, owner), schema)


_HELD: dict[str, tuple] = {}


def held(owner: str, key, make: Callable):
    """What ``make`` returns, kept in this Python worker for tasks with the same ``key`` until a task of
    another owner starts there: workers outlive the stages of a pipeline, whose models must not add up."""
    if owner not in _HELD or _HELD[owner][0] is not key:
        _HELD.clear()
        _HELD[owner] = (key, make())
    return _HELD[owner][1]


def give_back(owner: str = "") -> None:
    """Drop what this Python worker holds for others than ``owner``, and hand memory that is free in it
    back to the system, which allocators put off."""
    for other in [o for o in _HELD if o != owner]:
        del _HELD[other]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def trimmed(run: Callable, owner: str = "") -> Callable:
    """The Arrow map ``run``, whose task leaves no free memory in its worker: workers outlive tasks and
    stages, and what one of them kept would add to the needs of the next. What is ``held`` for ``owner`` stays."""

    def wrapped(batches):
        give_back(owner)
        yield from run(batches)
        give_back(owner)

    return wrapped


def trimmed_group(run: Callable) -> Callable:
    """The same for a function of a group's key and table."""

    def wrapped(key, table):  # without type hints, by some of which Spark would choose the kind of function
        out = run(key, table)
        give_back()
        return out

    return wrapped


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
