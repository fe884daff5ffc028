"""Mixing sources to target weights by systematic sampling.

Targets come from water-filling over a table with one row per source, in rounds of plain aggregates.
Documents are ranked inside their source by (size, hash of id, id) through one range sort of narrow rows, so neither
a hot source nor a tie needs a task of its own. The prefix sum of expected copies is rank times rate; one
random offset per source (a hash of its name) is added, and a document is taken once for each integer that its interval crosses.

Documents that alone hold more than a 16th of their source's words (there are such in small sources only) are a stratum of
their own with an offset of its own: they are settled first, and the rate of all others is what is then left of the
target, so that one long document doesn't move its source away from it. What every document may expect stays the same,
but where the others would have to be taken more than three times, or less than never, to make up for the long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded, cut_lineage, helper_prefix, input_partitions, ranked

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Documents whose size times this exceeds their source's are sampled before the others; there are fewer than that in a source.
LARGE = 16


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size); one row per source, spread over tasks."""
    per = cut_lineage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull()))
    placed = ranked(per, [], ["unnamed", "source"], input_partitions(per), "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("place", F.lit(len(WEIGHTS))) + 1).cast("int")).cast("double")
    weighed = cut_lineage(placed.select("source", "source_size", weight.alias("w"), (MAX_COPIES * F.col("source_size")).alias("cap")))
    total, level = weighed.agg(F.sum("source_size")).first()[0] or 0, -1.0
    while True:  # each round fixes the sources above their cap; the level only rises
        over = F.col("cap") / F.col("w") < level
        capped, free = weighed.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("w")))).first()
        now = (total - (capped or 0)) / free if free else level
        if now <= level:
            break
        level = now
    return weighed.select("source", "source_size", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("w")).alias("target"))


def copies(rate: Column, rank: Column, offset: Column) -> Column:
    """How many integers lie in the interval of expected copies from rank * rate to (rank + 1) * rate, moved by the offset."""
    return F.least(F.floor(rate * (rank + 1) + offset) - F.floor(rate * rank + offset), F.lit(MAX_COPIES))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "") -> DataFrame:
    """One row per row of docs: id, text_key, source, size, source_size, target, copies and taken.

    Size counts words; a null text has none, and a text of any length is one number. Null sources form one source, sorted last.
    A source without words has target 0 and gives nothing; an empty table gives an empty plan. Rows of one id and text are
    ranked apart. Reruns agree, as the plan depends on the rows and the seed alone.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")
    )
    narrow = cut_lineage(narrow.withColumn("tie", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))))
    targets = cut_lineage(source_targets(narrow))
    placed = ranked(narrow, ["source"], ["size", "tie", "id", "text_key"], input_partitions(docs), "rank").drop("tie")
    placed = placed.join(bounded(targets).withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    named = F.coalesce(F.concat(F.lit(f"s:{seed}"), F.col("source")), F.lit(seed))
    apart, offset = (F.conv(F.substring(F.md5(named), at, 6), 16, 10).cast("double") / (1 << 24) for at in (1, 7))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    large = F.col("size") * LARGE > F.col("source_size")
    placed = cut_lineage(placed.withColumn("large", large).withColumn("offset", offset).withColumn("first", F.when(large, copies(rate, F.col("rank"), apart))))
    settled = placed.groupBy("source").agg(
        F.coalesce(F.sum(F.when(F.col("large"), F.col("size") * F.col("first"))), F.lit(0)).alias("gone"), F.coalesce(F.sum(F.when(~F.col("large"), F.col("size"))), F.lit(0)).alias("rest")
    )
    settled = bounded(cut_lineage(settled.withColumnRenamed("source", "s3")))
    left = F.when(F.col("rest") > 0, F.least(F.greatest((F.col("target") - F.col("gone")) / F.col("rest"), F.lit(0.0)), F.lit(float(MAX_COPIES)))).otherwise(F.lit(0.0))
    out = placed.join(settled, F.col("source").eqNullSafe(F.col("s3"))).withColumn("copies", F.coalesce("first", copies(left, F.col("rank"), F.col("offset"))))
    return out.select("id", "text_key", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs with every row as often as the plan takes it; columns as they were, whatever their names.

    Rows of one id and text share their copies evenly, the first ones by a hash of the whole row taking what is over. Nulls, texts of any length and empty tables: as in ``mix_plan``.
    """
    p = helper_prefix(docs.columns, "_m_")
    plan = mix_plan(docs, id_col, text_col, source_col)
    each = plan.groupBy(F.col("id").alias(f"{p}id"), F.col("text_key").alias(f"{p}text")).agg(F.count("*").alias(f"{p}rows"), F.sum("copies").alias(f"{p}sum")).where(F.col(f"{p}sum") > 0)
    each = cut_lineage(each)
    keyed = docs.withColumn(f"{p}key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = keyed.join(each, F.col(id_col).eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}key") == F.col(f"{p}text")))
    out = rows.where(F.col(f"{p}rows") == 1).withColumn(f"{p}take", F.col(f"{p}sum"))
    if each.where(F.col(f"{p}rows") > 1).limit(1).count():
        more = rows.where(F.col(f"{p}rows") > 1).withColumn(f"{p}row", F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]))
        more = ranked(more, [f"{p}id", f"{p}text"], [f"{p}row"], input_partitions(docs), f"{p}at")
        n, total, at = F.col(f"{p}rows"), F.col(f"{p}sum"), F.col(f"{p}at")
        share = F.floor(total / n)
        out = out.unionByName(more.withColumn(f"{p}take", share + (at < total - share * n).cast("long")).drop(f"{p}row", f"{p}at"))
    out = out.where(F.col(f"{p}take") > 0).withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), F.col(f"{p}take").cast("int"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
