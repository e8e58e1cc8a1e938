"""Quality rules: a table of thresholds, compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoploom.llm.common import SPACE, WORD, nested, unnested

SYMBOLS = "[#*$%&|<>]"
# Very frequent words of English, French, German and Spanish.
STOP_WORDS = (
    "the be to of and that have with is it in for on as was a "
    "le la les de des et en un une que est dans pour du "
    "der die das und zu den von mit im ist ein eine auf "
    "el los las y por con para una se del al"
).split()

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """`part / whole` must lie in [least, most]; a whole of 0 makes the ratio 0."""

    name: str
    part: str
    whole: str
    least: float = float("-inf")
    most: float = float("inf")

    def holds(self) -> Column:
        ratio = F.when(F.col(self.whole) == 0, F.lit(0.0)).otherwise(F.col(self.part).cast("double") / F.col(self.whole))
        bounds = [ratio >= self.least] * (self.least > float("-inf")) + [ratio <= self.most] * (self.most < float("inf"))
        return reduce(Column.__and__, bounds)


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=16.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("copied_lines", "n_dup_lines", "n_lines", most=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", most=0.3),
)


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """`row` (all columns of `df`) and the counts that the rules use, as longs.

    For words in three-word windows that occur twice or more, the windows' 64-bit hashes are sorted with their places;
    equal neighbours are repeats. In order of place, each repeat adds the words by which it lies beyond the last one,
    three at most.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(value, SPACE), lambda w: w != "")
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(WORD))
    first = nested(df, _text=value, _words=words, _lines=lines)

    windows = F.when(
        F.size("_words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda k: F.xxhash64(F.get("_words", k), F.get("_words", k + 1), F.get("_words", k + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    second = first.withColumn("_windows", windows)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.transform("_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))
    third = second.withColumn("_order", F.when(repeated, F.sort_array(pairs)))

    def hash_at(k: Column) -> Column:
        return F.get("_order", k)["h"]

    repeats = F.filter("_order", lambda x, k: hash_at(k - 1).eqNullSafe(x["h"]) | hash_at(k + 1).eqNullSafe(x["h"]))
    fourth = third.withColumn("_repeats", F.sort_array(F.transform(repeats, lambda x: x["k"])))
    beyond = F.transform("_repeats", lambda at, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), at - F.get("_repeats", k - 1))))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.regexp_replace("_text", SPACE, "")),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(F.aggregate(beyond, F.lit(0), lambda a, b: a + b), F.lit(0)),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_lines": F.size("_lines"),
        "n_bullet_lines": F.size(F.filter("_lines", lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•]"))),
        "n_cut_lines": F.size(F.filter("_lines", lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
    }
    return fourth.select("row", *[c.cast("long").alias(name) for name, c in counts.items()])


def judged(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`row`, the counts, `base_failed`, `failed` (names of the rules broken) and `kept`.

    A null or empty text has no words, so it fails the base. Repeated rows are judged alike; any other columns of `df`
    stay inside `row`.
    """
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]), lambda name: name.isNotNull())
    kept = reduce(Column.__and__, [r.holds() for r in rules], ~base_failed)
    return measures(df, text).select("*", base_failed.alias("base_failed"), failed.alias("failed"), kept.alias("kept"))


def passing(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `df` that no rule rejects, with its columns.

    The row number is there for the optimiser: a filter isn't pushed below a projection that makes one, where it would
    compute every measure once more for each of its uses.
    """
    numbered = judged(df, text, rules).withColumn("_number", F.monotonically_increasing_id())
    return unnested(numbered.where(F.col("kept") & (F.col("_number") >= 0)))
