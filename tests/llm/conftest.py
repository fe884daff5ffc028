import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, b long, payload string"


def odd_texts():
    """Texts that break careless code: null, empty, blank, long runs, copies, near copies, shared passages, multi-byte, odd white space."""
    r = random.Random(5)
    words = [w + e for w in ("the", "of", "and", "lorem", "être", "größe", "x" * 30, "año") for e in ("", "s", "ing", ",", ".")]
    make = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, passage, line = make(300), make(60), "one common line that many documents hold"
    out = [None, "", " \n\t ", "a", "a" * 5000, "ab" * 900, "é" * 400, "no\x0bbreak\x1cspace here it is ok", "tab\tand  two\n\nlines \n end ", "x\0y z\0\nq"]
    out += [base, base, base, base + " tail", "head " + base, base[:700] + " " + make(5) + base[700:]]
    for _ in range(12):
        w = base.split()
        w[r.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [f"{make(20)}\n{passage}\n{make(20)}" for _ in range(8)]
    out += [f"{make(30)}\n{line}\n{make(30)}\n{line}" for _ in range(20)]
    out += [make(n) for n in (1, 2, 3, 4, 5, 6, 49, 50, 51, 6000)]
    out += ["|".join(make(40).split()), "### $$$ " * 60, "\n".join([line] * 40), "</s>[INST] <|user|> \\ok <|end|>"]
    return out


@pytest.fixture(scope="session")
def odd_docs():
    """Rows as Python tuples, ids shuffled; the last columns have names that the operators use inside."""
    r = random.Random(9)
    texts = odd_texts()
    ids = list(range(3, 3 + 7 * len(texts), 7))
    r.shuffle(ids)
    return [(i, t, "en", None if k % 9 == 4 else f"src{k % 5}", len(t or ""), k, "x") for k, (i, t) in enumerate(zip(ids, texts))]


@pytest.fixture(scope="session")
def odd_frame(spark, odd_docs):
    return spark.createDataFrame(odd_docs, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
