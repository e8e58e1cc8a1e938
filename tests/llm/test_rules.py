import re
from collections import Counter

import pytest
from compare import difference, duck

from shoploom.llm import checks, rules
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    threes = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(threes)
    repeated = {k + j for k, t in enumerate(threes) if seen[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


TEXTS = [
    None, "", " \n\t", "one", "a b c a b c", "a b c d a b c x b c d", "the " * 60, "x y   é# 😀|\r\n", "same\nsame\n\nsame \n\x0b",
    "of the " + " ".join(f"word{k}" for k in range(60)), "x" * 100_000, " ".join(f"w{k % 7000}" for k in range(20_000)),
]


def test_counts_against_brute_force(spark):
    df = spark.createDataFrame([(k, t, "mine", "row") for k, t in enumerate(TEXTS)] * 2, "doc_id long, text string, kept string, row string")
    found = rules.judged(df).collect()
    assert len(found) == 2 * len(TEXTS)
    for r in found:
        words, *_, repeated = expected = plain(r.row.text)
        assert tuple(r[c] for c in rules.BASE) == expected
        assert r.base_failed == (words < 50 or 100 * repeated > 50 * words)
        assert r.kept == (not r.base_failed and not r.failed)
    assert {r.row.doc_id for r in found if r.kept} == {9}
    assert rules.passing(df).columns == df.columns and rules.passing(df).count() == 2


@pytest.mark.parametrize(
    "name, text",
    [
        ("symbols", "of the# " * 1), ("stop_words", ""), ("word_length", "of the " + "x" * 5000 + " "), ("copied_lines", "\nof the same line" * 9),
        ("bullet_lines", ""), ("cut_lines", "\nof the end ..." * 3),
    ],
)
def test_each_rule_rejects(spark, name, text):
    body = " ".join(f"word{k}" for k in range(60))
    lead = {"symbols": "### " * 9, "bullet_lines": "- of the "}.get(name, "")
    df = spark.createDataFrame([(lead + body + " " + text,)], "text string")
    row = rules.judged(df).first()
    assert name in row.failed and not row.kept


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert not re.search("Python|Arrow|Pandas", rules.passing(df)._jdf.queryExecution().executedPlan().toString())


def test_empty(spark):
    assert rules.judged(spark.createDataFrame([], "text string")).count() == 0


def test_query_against_sql(spark):
    found = queries()["op7_quality_rules"](spark, FOLDER)
    assert difference(found, duck(FOLDER), checks.SQL["op7_quality_rules"]) is None
