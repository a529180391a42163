"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storylens.session import scratch_path

_shipped: set[str] = set()
#: Rows of an Arrow batch that are Python objects at once.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def ship_package(spark: SparkSession) -> None:
    """Put this package on the executors' path, once for each application.

    The functions that run in Python workers keep tables and caches between
    tasks as module state, so workers must import the modules.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="storylens-"), "storylens_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text under fixed names; a null text counts as empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def map_columns(df: DataFrame, inputs: list[str], outputs: str,
                make: Callable[[], Callable[..., list]], together: int | None = None) -> DataFrame:
    """Append columns made from Arrow batches; ``outputs`` is a DDL list.

    ``make()`` runs once in each task and returns a function from the input
    columns (Python lists) to the output columns (lists, or Arrow or numpy
    arrays). An output replaces an input column of the same name. It gets ``SLICE``
    rows at a time, or so many that they have about ``together`` bytes.
    """
    ship_package(df.sparkSession)
    new = T._parse_datatype_string(outputs)
    kept = [c for c in df.columns if c not in new.names]
    schema = T.StructType([df.schema[c] for c in kept] + new.fields)
    arrow = to_arrow_schema(schema)

    def rows(batch: pa.RecordBatch) -> int:
        return SLICE if together is None else max(1, together * batch.num_rows // max(batch.nbytes, 1))

    def run(batches):
        fn = make()
        for b in (whole.slice(k, n) for whole in batches for n in [rows(whole)] for k in range(0, whole.num_rows, n)):
            made = fn(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in inputs))
            old = [b.column(b.schema.get_field_index(c)) for c in kept]
            made = [x if isinstance(x, pa.Array) else pa.array(x, type=arrow.field(f.name).type)
                    for f, x in zip(new.fields, made, strict=True)]
            old = [x if x.type == arrow.field(c).type else x.cast(arrow.field(c).type)
                   for c, x in zip(kept, old, strict=True)]
            yield pa.RecordBatch.from_arrays(old + made, schema=arrow)

    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a new start of the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_bound(share: float) -> int:
    """The largest 64-bit hash of that share of all of them: a sample that costs one filter."""
    return min(int(-(1 << 63) + min(1.0, max(0.0, share)) * ((1 << 64) - 1)), (1 << 63) - 1)


_state: dict = {}


def worker_state(key: tuple, make: Callable):
    """What a Python worker keeps between tasks: one operator's tables and memories at a time."""
    if key not in _state:
        _state.clear()
        _state[key] = make()
    return _state[key]


def meet(blocks: DataFrame, queries: DataFrame, load: Callable[[dict], object], answer: Callable[[object, dict], list[tuple]],
         schema: str) -> DataFrame:
    """``answer(block, query)`` of every row of ``blocks`` and every row of ``queries``, as rows of whole numbers.

    ``blocks`` has a number ``block`` for each of its few large rows, which ``load`` makes ready; ``schema`` is a DDL
    list. A block comes first in its group and the queries stream past it: one copy of the queries goes to each
    block, and the blocks move once, however many queries there are.
    """
    spark = queries.sparkSession
    ship_package(spark)
    numbers = [r.block for r in blocks.select("block").collect()]  # a row for each block
    copies = queries.withColumn("block", F.explode(F.array(*(F.lit(b).cast("long") for b in numbers)))) if numbers \
        else queries.withColumn("block", F.lit(0).cast("long"))
    both = blocks.withColumn("kind", F.lit(0)).unionByName(copies.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    met = both.repartition(max(len(numbers), 1), "block").sortWithinPartitions("block", "kind")
    fields, held, wanted = both.columns, blocks.columns, queries.columns
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        number, block = None, None
        for b in batches:
            column = {f: b.column(i) for i, f in enumerate(fields)}
            out: list[tuple] = []
            for r, (at, kind) in enumerate(zip(column["block"].to_pylist(), column["kind"].to_pylist())):
                if kind == 0:
                    number, block = at, load({c: column[c][r].as_py() for c in held})
                elif at == number:
                    out += answer(block, {c: column[c][r].as_py() for c in wanted})
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return met.mapInArrow(run, schema)
