"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that parts words: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Folders that this process has made in the shared folder; ``clean_scratch`` deletes them.
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session in one process (tests) gets a temporary one; on a cluster that is an error, as
    executors would not see the driver's folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        found = jsc.getCheckpointDir().get() if jsc.getCheckpointDir().isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        found = "file://" + tempfile.mkdtemp(prefix="gridscan-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A new folder name below the shared folder."""
    _made.append(f"{shared_dir(spark).rstrip('/')}/gridscan-{what}-{uuid.uuid4().hex}")
    return _made[-1]


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clean_scratch(spark: SparkSession) -> int:
    """Delete the folders that operators of this process have left for their results; the results can't be read any more."""
    n = len(_made)
    while _made:
        _delete(spark, _made.pop())
    return n


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: what follows survives the loss of any executor and never recomputes ``df``."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a frame that ``cut_lineage`` gave, once nothing reads it any more."""
    file = df._jdf.queryExecution().analyzed().collectLeaves().apply(0).rdd().getCheckpointFile()
    if file.isDefined():
        _delete(df.sparkSession, file.get())


def helper_prefix(columns: Iterable[str], start: str) -> str:
    """``start``, lengthened until no column begins with it, so that helper columns never meet a user's."""
    taken = [c.lower() for c in columns]
    k, prefix = 0, start
    while any(c.startswith(prefix.lower()) for c in taken):
        k += 1
        prefix = f"{start}{k}_"
    return prefix


#: Stored bytes of input per partition of a shuffle that carries whole texts.
PARTITION_BYTES = 16 << 20


def stored_bytes(df: DataFrame) -> int:
    """Bytes of what a frame reads, by the optimizer's figures; an RDD of unknown size counts PARTITION_BYTES a partition."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        size = int(str(leaf.stats().sizeInBytes()))
        if size < 1 << 60:
            total += size
        elif leaf.getClass().getSimpleName() == "LogicalRDD":
            total += leaf.rdd().getNumPartitions() * PARTITION_BYTES
    return total


def input_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle that carries the texts of df: the session's number, more where the input is large."""
    spark = df.sparkSession
    least = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(least, min(stored_bytes(df) // PARTITION_BYTES, 1 << 17))


def words_of(text: Column | str) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != F.lit(""))


def shingle_hashes(words: Column, width: int) -> Column:
    """64-bit hashes of all runs of ``width`` words, repeats included; a shorter text has one run, a blank one none."""
    whole = F.xxhash64(words)
    n = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(n - F.lit(width), F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + F.lit(k)) for k in range(width)]),
    )
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < width, F.array(whole)).otherwise(runs)


def constant(values: list[int]) -> Column:
    """The numbers as one constant array, however many."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


@dataclass(frozen=True)
class Ranges:
    """Ranges of a long key in ascending order, null keys in front: ``bounds`` are the lower ends of all ranges but the first,
    ``parts`` says into how many buckets each range
    is split by a second, 64-bit key; only a range of one key value has several. ``least`` is the least key there is.
    """

    bounds: tuple[int, ...]
    nulls: int
    parts: tuple[int, ...]
    least: int | None = None
    has_nulls: bool = True

    @property
    def buckets(self) -> int:
        return self.nulls + sum(self.parts)

    def bucket(self, key: Column, tie: Column) -> Column:
        """The bucket of a row, by binary search; buckets follow the order of (key, tie), null keys first."""
        at = constant(list(self.bounds))
        steps = F.array(*[F.lit(1 << b) for b in range(len(self.bounds).bit_length() - 1, -1, -1)]) if self.bounds else F.array().cast("array<int>")
        range_no = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(at, low + step - 1) <= key, low + step).otherwise(low))
        high = F.shiftright(tie, 33) + F.lit(1 << 30)  # the tie's upper bits, order kept, from 0 to 2^31
        within = lambda n: F.shiftright(high * n, 31)
        null = within(F.lit(self.nulls).cast("long"))
        if max(self.parts) == 1:
            return F.when(key.isNull(), null).otherwise(range_no + self.nulls).cast("int")
        first, held = [], self.nulls
        for n in self.parts:
            first.append(held)
            held += n
        placed = F.get(constant(first), range_no) + within(F.get(constant(list(self.parts)), range_no))
        return F.when(key.isNull(), null).otherwise(placed).cast("int")


def range_buckets(df: DataFrame, key: str, buckets: int) -> Ranges:
    """Ranges of about as many rows, about ``buckets`` of them; lower ends are values that occur.

    Only the key column is read. Keys are counted in cells of equal width, and cells that hold more than
    their share are counted anew in finer ones. A value that alone holds more than its share, null included, gets
    several buckets. The ranges depend on the rows alone, and the driver gets a few numbers per range.
    """
    keys = df.select(F.col(f"`{key}`").cast("long").alias("k"))
    total, n, lo, hi = keys.agg(F.count("*"), F.count("k"), F.min("k"), F.max("k")).first()
    share = max(1.0, total / max(1, buckets))
    parts_of = lambda count: max(1, min(buckets, round(count / share)))
    nulls = parts_of(total - n)
    if buckets < 2 or not n:
        return Ranges((), nulls, (1,), lo, n < total)
    keys = keys.where("k is not null")
    cells = [(lo, hi, n)]
    for _ in range(4):
        large = sorted((c for c in cells if c[2] > 1.25 * share and c[1] > c[0]), key=lambda c: -c[2])[:8]
        if not large:
            break
        for c in large:
            cells.remove(c)
            width = (c[1] - c[0] + 1) / max(16, 8 * int(c[2] / share))
            cell = F.floor((F.col("k").cast("double") - float(c[0])) / width)
            got = keys.where(F.col("k").between(c[0], c[1])).groupBy(cell).agg(F.min("k"), F.max("k"), F.count("*")).collect()
            cells += [(x[1], x[2], x[3]) for x in got]
    bounds: list[int] = []
    parts: list[int] = [1]
    held, alone = 0, False
    for least, most, count in sorted(cells):
        hot = least == most and parts_of(count) > 1
        if held and (hot or alone or held >= share):
            bounds.append(int(least))
            parts.append(1)
            held = 0
        if hot:
            parts[-1] = parts_of(count)
        alone = hot
        held += count
    return Ranges(tuple(bounds), nulls, tuple(parts), lo, n < total)


def ranked(df: DataFrame, group: list[str], order: list[str], partitions: int, name: str) -> DataFrame:
    """df with ``name``, each row's place (from 0) within its group by ``order``, checkpointed.

    Rows are range-sorted over all tasks, equal ones spread by a seeded random number, and each task's part of
    a group is counted: neither a hot group nor a tie needs a task of its own, and the only window holds one row per task and group.
    """
    p = helper_prefix(df.columns, "_r_")
    keys = [F.col(c) for c in [*group, *order]]
    placed = df.withColumn(f"{p}tie", F.rand(7)).repartitionByRange(partitions, *keys, f"{p}tie").sortWithinPartitions(*keys, f"{p}tie")
    placed = cut_lineage(placed.withColumn(f"{p}at", F.monotonically_increasing_id()).withColumn(f"{p}part", F.shiftright(f"{p}at", 33)).drop(f"{p}tie"))
    starts = placed.groupBy(*group, f"{p}part").agg(F.min(f"{p}at").alias("least"), F.count("*").alias("n"))
    ahead = Window.partitionBy(*group).orderBy(f"{p}part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("least")).alias(f"{p}shift")
    starts = bounded(cut_lineage(starts.select(*[F.col(c).alias(f"{p}g{i}") for i, c in enumerate(group)], F.col(f"{p}part").alias(f"{p}p"), shift)))
    same = F.col(f"{p}part") == F.col(f"{p}p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"{p}g{i}"))
    out = placed.join(starts, same).withColumn(name, F.col(f"{p}at") + F.col(f"{p}shift"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], name)


#: A table is broadcast up to so many rows and bytes of strings; a larger one is joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 16 << 20


def bounded(df: DataFrame) -> DataFrame:
    """A checkpointed table, marked for broadcast if it is small by rows and bytes."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    size = sum(texts, F.lit(0)).cast("long")
    n, held = df.agg(F.count("*"), F.sum(size)).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES else df
