"""Quality rules: a threshold table compiled into one native Spark projection.

All figures come from arrays inside the row, so nothing is shuffled: the plan is scan and project.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, helper_prefix, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that for on with was are as it be by at this from have or an not he she they we you "
    "der die das und in zu den ist von mit für auf dem ein eine nicht des im sich es "
    "le la les de des et un une est du en que qui pour dans pas sur au "
    "el los las del y una por con para se no al lo su"
).split()

#: (name, numerator, denominator, least, most): a row fails where numerator / denominator lies outside.
#: A denominator of 0 passes.
THRESHOLDS: list[tuple[str, str, str, float | None, float | None]] = [
    ("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    ("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    ("stop_word_ratio", "n_stop_words", "n_words", 0.01, None),
    ("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3


def with_quality_counts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and n_stop_words behind a prefix, and that prefix.

    A null text counts as an empty one. The prefix is one that no column of docs begins with, so all columns stay, whatever their names.
    """
    p = helper_prefix(docs.columns, "_q_")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    out = docs.withColumn(f"{p}words", words_of(text)).withColumn(f"{p}lines", lines)
    words = F.col(f"{p}words")
    n = F.size(words)
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn(f"{p}hashes", windows)
    # (prefix of the hash, position) in one long: 64-bit primitives sort fast.
    out = out.withColumn(f"{p}bits", F.when(F.size(f"{p}hashes") < (1 << 16), F.lit(16)).otherwise(F.lit(31)))
    out = out.withColumn(
        f"{p}sorted",
        F.expr(f"sort_array(transform({p}hashes, (h, i) -> shiftleft(shiftrightunsigned(h, {p}bits), {p}bits) | cast(i as bigint)))"),
    )
    out = out.withColumn(
        f"{p}near",
        F.expr(
            f"transform(filter({p}sorted, (p, j) -> "
            f"coalesce(shiftrightunsigned(p, {p}bits) = shiftrightunsigned(get({p}sorted, j - 1), {p}bits), false) or "
            f"coalesce(shiftrightunsigned(p, {p}bits) = shiftrightunsigned(get({p}sorted, j + 1), {p}bits), false)), "
            f"p -> cast(p & (shiftleft(1L, {p}bits) - 1) as int))"
        ),
    )
    # Naming the hashes twice keeps the optimizer from computing them anew for every element.
    out = out.withColumn(
        f"{p}pairs",
        F.expr(f"if(size({p}hashes) = 0, cast(array() as array<struct<h:bigint,i:int>>), sort_array(transform({p}near, i -> struct(get({p}hashes, i) as h, i as i))))"),
    )
    out = out.withColumn(
        f"{p}at",
        F.expr(
            f"sort_array(transform(filter({p}pairs, (p, j) -> "
            f"coalesce(p.h = get({p}pairs, j - 1).h, false) or coalesce(p.h = get({p}pairs, j + 1).h, false)), p -> p.i))"
        ),
    )
    # The row number, times 0, keeps filters above this projection: pushed below it they would repeat
    # every array expression at each mention.
    counts = {
        "n_words": F.size(words) + F.monotonically_increasing_id() * 0,
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(f"{p}lines").cast("long"),
        "n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
        "n_repeat_words": F.expr(f"aggregate(transform({p}at, (p, j) -> least({WINDOW}, p - coalesce(get({p}at, j - 1), p - {WINDOW}))), 0L, (a, x) -> a + x)"),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))).cast("long"),
    }
    helpers = [f"{p}{c}" for c in ("words", "lines", "hashes", "bits", "sorted", "near", "pairs", "at")]
    return out.select("*", *[c.alias(p + k) for k, c in counts.items()]).drop(*helpers), p


def base_failed(prefix: str) -> Column:
    """Too few words, or more than half of them in windows that repeat."""
    n = F.col(f"{prefix}n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{prefix}n_repeat_words") > MAX_REPEAT_PERCENT * n)


def verdict(prefix: str, table: list[tuple[str, str, str, float | None, float | None]] | None = None) -> Column:
    """The threshold table as one boolean expression: true where every ratio lies inside its bounds."""
    ok = F.lit(True)
    for _, over, under, least, most in THRESHOLDS if table is None else table:
        a, b = F.col(f"{prefix}{over}").cast("double"), F.col(f"{prefix}{under}").cast("double")
        if least is not None:
            ok = ok & ((b == 0) | (a >= least * b))
        if most is not None:
            ok = ok & ((b == 0) | (a <= most * b))
    return ok


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: its counts, base_failed and kept.

    Null, empty and blank texts have no words and fail; texts of any length are counted whole; repeated rows and rows without
    an id each get their own row; an empty table gives an empty one.
    """
    counted, p = with_quality_counts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return counted.select(
        F.col("id").alias(id_col),
        *[F.col(p + c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(p).alias("base_failed"),
        (~base_failed(p) & verdict(p)).alias("kept"),
    )


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that pass, as ``quality_report`` tells; columns as they were, whatever their names."""
    counted, p = with_quality_counts(docs, text_col)
    return counted.where(~base_failed(p) & verdict(p)).select(*[F.col(f"`{c}`") for c in docs.columns])
