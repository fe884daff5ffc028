import re

from gridscan.llm import queries, quality_rules

from .conftest import SCHEMA, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in wins:
        seen[w] = seen.get(w, 0) + 1
    inside = {j for i, w in enumerate(wins) if seen[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed, lines, words


def verdict(b):
    n, chars, symbols, dup, _, failed, lines, words = b
    stop = sum(w in set(quality_rules.STOP_WORDS) for w in words)
    return not failed and 2 * n <= chars <= 15 * n and symbols <= 0.1 * n and stop >= 0.01 * n and dup <= 0.5 * len(lines)


def check(df, docs):
    got = sorted((tuple(x) for x in df.collect()), key=str)
    want = sorted(((d[0], *(b := brute(d[1]))[:6], verdict(b)) for d in docs), key=str)
    assert got == want


def test_query(spark, small_docs):
    check(queries.QUERIES["op10_quality_rules"](spark, SF), small_docs)


def test_odd_texts(spark, odd_frame, odd_docs, empty_frame):
    check(quality_rules.quality_report(odd_frame), odd_docs)
    assert quality_rules.quality_report(empty_frame).count() == 0
    assert quality_rules.quality_filter(empty_frame).columns == empty_frame.columns


def test_long_texts_use_the_other_key_width(spark):
    text = " ".join(f"w{i % 70000}" for i in range(70500))
    check(quality_rules.quality_report(spark.createDataFrame([(1, text, None, None, None, None, None)], SCHEMA)), [(1, text)])


def test_plan_is_scan_and_project(spark):
    plan = quality_rules.quality_report(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_filter_keeps_rows_as_they_are(odd_frame, odd_docs):
    kept = sorted(d[0] for d in odd_docs if verdict(brute(d[1])))
    out = quality_rules.quality_filter(odd_frame)
    assert out.columns == odd_frame.columns and sorted(x.doc_id for x in out.collect()) == kept


def test_labelled_good_documents_pass_unless_the_base_fails(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules.quality_report(docs).join(labels, "doc_id").where("not base_failed")
    good = rows.where("quality = 1")
    bad = rows.where("quality = 0")
    assert good.where("kept").count() >= 0.99 * good.count()
    assert bad.where("not kept").count() >= 0.9 * bad.count()
