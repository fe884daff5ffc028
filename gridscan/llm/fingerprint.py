"""Document fingerprints: one-permutation MinHash, in native expressions only.

A text's 5-word shingles are hashed once; the top bits of a hash choose one of 256 bins, and a bin keeps
its least hash. Sorting the hashes brings each bin's least to the front of its run, so one filter finds
them all. An empty bin borrows from the first full bin of a pseudo-random order of all bins that is its own and the
same for all documents (optimal densification): a few bins by hash come first, the others by the least
hash of the pair of bins. The low 8 bits of each bin are kept, and the share of equal bins is corrected for chance matches of 2^-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Ranges, constant, helper_prefix, input_partitions, range_buckets, shingle_hashes, words_of

BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 8
WIDTH = 5
#: Bins of an empty bin's order that are tried one by one; only where all of them are empty too is the least hash sought.
EARLY = 6


def with_fingerprint(df: DataFrame, text: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with ``name``, an array of BINS small integers; empty for a null text or one without words."""
    p = helper_prefix(df.columns, f"_{name}_")
    h, least, dense = f"{p}h", f"{p}m", f"{p}d"
    out = df.withColumn(f"{p}w", words_of(text))
    out = out.withColumn(h, F.sort_array(shingle_hashes(F.col(f"{p}w"), width))).drop(f"{p}w")
    shift, half, low = 64 - BIN_BITS, BINS // 2, (1 << LOW_BITS) - 1
    out = out.withColumn(least, F.expr(f"filter({h}, (x, i) -> i = 0 or shiftright(x, {shift}) <> shiftright(get({h}, i - 1), {shift}))")).drop(h)
    at = f"cast(shiftright(%s, {shift}) + {half} as int)"
    gap = f"coalesce({at % f'get({least}, i + 1)'}, {BINS}) - {at % 'x'} - 1"
    out = out.withColumn(
        dense,
        F.expr(
            f"case when size({least}) = 0 then cast(array() as array<bigint>) else concat(array_repeat(cast(null as bigint), {at % f'get({least}, 0)'}), "
            f"flatten(transform({least}, (x, i) -> concat(array(x), array_repeat(cast(null as bigint), {gap}))))) end"
        ),
    )
    early = ", ".join(f"get({dense}, cast(pmod(xxhash64(j, {a}), {BINS}) as int))" for a in range(1, EARLY + 1))
    # The pair's hash in the upper bits, the lender's low bits below: the least of these numbers names the lender.
    rest = f"array_min(transform({least}, y -> (xxhash64(j, shiftright(y, {shift})) & {~low}L) | (y & {low})))"
    out = out.withColumn(name, F.expr(f"transform({dense}, (x, j) -> cast(coalesce(x, {early}, {rest}) & {low} as smallint))"))
    return out.drop(least, dense)


def packed(fingerprint: Column) -> Column:
    """The fingerprint as lower-case hex; empty for a text without words."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), LOW_BITS // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints: 1 for two texts without words, 0 for one."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    chance = 2.0**-LOW_BITS
    fixed = F.least(F.greatest((same - chance) / (1 - chance), F.lit(0.0)), F.lit(1.0))
    return F.when(F.size(a) != F.size(b), F.lit(0.0)).when(F.size(a) == 0, F.lit(1.0)).otherwise(fixed)


def with_next(rows: DataFrame, key: str, tie: Column, columns: list[str], buckets: int) -> DataFrame:
    """rows with ``next_<c>`` for each of the columns, taken from the next row by (key, tie); the last row's next is the first.

    Rows are shuffled once, by ranges of the key; a hot key's rows, or those without one, which come first, are dealt to several
    ranges by the 64-bit tie. Each range also gets a copy of the first row behind it, so the window needs no row of another range. Only rows
    equal in key and tie can't be parted.
    """
    p = helper_prefix(rows.columns, "_n_")
    k, b, t, ghost = F.col(f"`{key}`").cast("long"), f"{p}b", f"{p}t", f"{p}ghost"
    ranges = range_buckets(rows, key, buckets)
    placed = rows.withColumn(t, tie).withColumn(b, ranges.bucket(k, F.col(t)))
    copy = _copied(placed, ranges, k, b, t)
    dealt = placed.withColumn(f"{p}at", F.explode(F.concat(F.array(F.struct(F.col(b).alias("b"), F.lit(0).alias("ghost"))), copy)))
    dealt = dealt.withColumn(b, F.col(f"{p}at.b")).withColumn(ghost, F.col(f"{p}at.ghost")).drop(f"{p}at").repartitionById(ranges.buckets, b)
    order = Window.partitionBy(b).orderBy(ghost, F.col(f"`{key}`").asc_nulls_first(), t)
    return dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where(F.col(ghost) == 0).drop(b, ghost, t)


def _copied(placed: DataFrame, ranges: Ranges, k: Column, b: str, t: str) -> Column:
    """For the first row of each bucket the bucket before it, around from the first to the last; for others nothing.

    A range of several keys begins with rows of its lower bound; the first tie of a hot key's buckets, and of null
    keys, is looked up: the driver gets one row for each of those buckets.
    """
    lower = [ranges.least, *ranges.bounds]
    hot = [v for v, n in zip(lower, ranges.parts) if n > 1]
    heads: dict[int, tuple] = {}
    at = ranges.nulls
    for v, n in zip(lower, ranges.parts):
        if n == 1 and v is not None:
            heads[at] = (2, v, 0)
        at += n
    if hot or ranges.has_nulls:
        some = placed.where(k.isNull() | k.isin(hot)) if hot else placed.where(k.isNull())
        for r in some.groupBy(F.col(b).alias("b")).agg(F.first(k).alias("k"), F.min(t).alias("t")).collect():
            heads[r.b] = (1, 0, r.t) if r.k is None else (3, r.k, r.t)
    none = F.array().cast("array<struct<b:int,ghost:int>>")
    if not heads:
        return none
    there = sorted(heads)
    before = dict(zip(there, [there[-1], *there]))
    every = [heads.get(i, (0, 0, 0)) for i in range(ranges.buckets)]
    kind, value, first = (F.get(constant([h[i] for h in every]), F.col(b)) for i in range(3))
    known = F.when(kind == 2, k == value).when(kind == 3, (k == value) & (F.col(t) == first)).when(kind == 1, k.isNull() & (F.col(t) == first))
    to = F.get(constant([before.get(i, 0) for i in range(ranges.buckets)]), F.col(b)).cast("int")
    return F.when(F.coalesce(known, F.lit(False)), F.array(F.struct(to.alias("b"), F.lit(1).alias("ghost")))).otherwise(none)


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs its fingerprint, that of its edited text (the last quarter replaced by the head of the next document) and likenesses.

    Null texts are empty and have an empty fingerprint; texts of any length are hashed whole. Rows without an id come first; of rows
    with one id, the next is found by a hash of the text. The only row of a table is its own next; an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.length(text).alias("n"))
    rows = with_fingerprint(rows, F.col("text"), "fp")
    rows = with_next(rows, "id", F.xxhash64("text"), ["text", "fp"], input_partitions(docs))
    cut = F.floor(F.col("n") / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n") - cut), F.substring("next_text", F.lit(1), cut))).drop("text", "next_text")
    rows = with_fingerprint(rows, F.col("edited"), "efp")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("fp")).alias("fingerprint"),
        packed(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
