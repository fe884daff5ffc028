"""Columns of the user's that are named like the operators' own helpers stay as they are."""

import pytest
from pyspark.sql import functions as F

from gridscan.llm import fingerprint, mixing, quality_rules, simhash, suffix_dedup

NAMES = [
    *(f"_q_{c}" for c in "words lines hashes bits sorted near pairs at n_words n_lines n_stop_words word_chars n_symbols n_dup_lines n_repeat_words".split()),
    *(f"_s_{c}" for c in "key text b id source".split()),
    *(f"_d_{c}" for c in "id text key rows".split()),
    *(f"_m_{c}" for c in "id text key rows sum each take copy row at".split()),
    *(f"_r_{c}" for c in "tie at part g0 g1 p shift".split()),
    *"id text_key fp root node key bucket size rank copies target taken first place kind n tie like keys x groups _n_b _n_t _n_ghost _n_at _l_id h".split(),
]
STAGES = {"rules": quality_rules.quality_filter, "simhash": simhash.simhash_dedup, "suffixes": suffix_dedup.remove_repeats, "mix": mixing.mix}


@pytest.fixture(scope="module")
def named(odd_frame):
    return odd_frame.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


@pytest.mark.parametrize("stage", STAGES)
def test_stages_keep_columns_of_any_name(named, odd_frame, stage):
    out = STAGES[stage](named)
    assert out.columns == named.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
    plain = STAGES[stage](odd_frame)
    assert sorted(map(str, (r[: len(odd_frame.columns)] for r in rows))) == sorted(map(str, map(tuple, plain.collect())))


@pytest.mark.parametrize("stage", STAGES)
def test_repeated_rows_with_such_columns(spark, named, stage):
    """The same rows three times, some without an id."""
    some = named.limit(12)
    frame = some.unionByName(some).unionByName(some.withColumn("doc_id", F.lit(None).cast("long")))
    out = STAGES[stage](frame)
    assert out.columns == named.columns
    assert all(r[NAMES[0]].startswith(NAMES[0]) and r[NAMES[-1]].startswith(NAMES[-1]) for r in out.collect())


def test_reports_read_their_own_columns_alone(named, odd_frame):
    for report in (quality_rules.quality_report, suffix_dedup.repeat_report, simhash.simhash_groups, fingerprint.fingerprint_report):
        assert sorted(map(str, report(named).collect())) == sorted(map(str, report(odd_frame).collect()))
