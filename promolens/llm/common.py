"""What the operators share: Arrow maps, stored intermediate tables, a numbering of rows."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from promolens.sources import scratch_dir

#: Rows and bytes taken from an Arrow batch at a time, so that few Python strings live at once; a
#: row larger than this is taken alone.
ROWS = 256
BYTES = 4 << 20

Columns = dict[str, list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back.

    It cuts the lineage: a lost executor takes no finished task's rows with it, and what a task
    decided (its number, the order it met rows in) stays as it was written.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, most: int = ROWS) -> Iterator[pa.RecordBatch]:
    """`batch` in order, halved until each piece keeps to `most` rows and `BYTES`."""
    if batch.num_rows > 1 and (batch.num_rows > most or batch.nbytes > BYTES):
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half), most)
        yield from pieces(batch.slice(half), most)
    elif batch.num_rows:
        yield batch


#: What this Python worker keeps for the tasks to come, and the module it keeps it for.
_kept: dict = {}
_owner: str | None = None


def kept(name: Hashable, make: Callable[[], object]):
    """An object that lives on after its task, until tasks of another module come: a worker that
    serves one operator after the other holds the memory of one."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def serve(module: str) -> None:
    global _owner
    if module != _owner:
        _kept.clear()
        _owner = module


def map_columns(
    df: DataFrame,
    rows: Callable[[Iterable[Columns]], Iterator[Columns]],
    schema: str,
    most: int = ROWS,
) -> DataFrame:
    """A task's rows through `rows`, which gets and gives columns of `most` input rows or fewer."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serve(rows.__module__)
        for out in rows(p.to_pydict() for b in batches for p in pieces(b, most)):
            yield pa.RecordBatch.from_pydict(out, kind)
        # A worker lives on after its task; other tasks shall have the memory.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def hash_edge(most: int, total: int) -> int:
    """The largest signed 64-bit hash to keep so that, of `total` rows, `most` are hardly missed."""
    share = min(1.0, (most + 4 * most**0.5) / max(total, 1))
    return min(int(share * 2**64) - 2**63, 2**63 - 1)


def hashed_share(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """The rows whose hashed columns `by` are least, about `most` of them, all if there are fewer.

    The edge follows from the count of rows, so no row is shuffled. Rows alike in `by` go together.
    """
    total = rows.count()
    if total <= most:
        return rows
    return rows.where(F.xxhash64(*by) <= hash_edge(most, total))


def drawn(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """At most `most` rows, those whose hashed columns `by` are least, however many are alike.

    Only the few rows below the edge of `hashed_share` are ranked; `rows` should be stored.
    """
    return hashed_share(rows, by, most).orderBy(F.xxhash64(*by), *by).limit(most)


def bounded(memory: dict, most: int) -> dict:
    """`memory` itself, or once it is too large its older half: frequent keys come early."""
    return memory if len(memory) <= most else dict(islice(memory.items(), most // 2))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def running_offsets(parts: DataFrame, order: list, amount: str, name: str) -> DataFrame:
    """`parts` with the sum of `amount` over the parts before.

    `parts` has one row for each task or cell of a stored table, so it is as small as the count
    of tasks, whatever the rows.
    """
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, F.coalesce(F.sum(amount).over(before), F.lit(0)))
