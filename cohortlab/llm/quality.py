"""Quality rules as a short-circuit cascade (operator 13, DataFrame functions only).

Each rule is a failure condition. On a sample, one small job per rule says how
often it rejects and what it costs beyond reading the rows; the rules are then
ordered by rejections per second, and a CASE expression tries them in that
order, so that a text pays only for the rules up to the first that rejects it.
The order changes what a run costs, never what it keeps.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortlab.llm.tables import written

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"#*$%&|<>"        #: members of a character class, as the next two
CAPITALS = r"A-Z"
NO_LETTERS = r"0-9\p{Punct}"
WINDOW = 8            #: words of a window that counts as repeated
SAMPLE_ROWS = 2000    #: rows on which costs and rejections are estimated, about
SAMPLE_SEED = 13
LEAST_SECONDS = 1e-3  #: a rule's cost is at least this, so that the clock's grain ranks nothing


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once, though it is used many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def count_of(text: Column, chars: str) -> Column:
    """How many of the characters of `text` are in the class `chars`: the runs of others go at once."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _windows(h: Column, span: int, width: int) -> Column:
    """Hashes of the runs of `width` words, from those of the runs of `span` words: by doubling,
    the last two overlapping."""
    if span == width:
        return h
    step = min(span, width - span)
    short = F.greatest(F.size(h) - step, F.lit(0))
    wider = F.zip_with(F.slice(h, F.lit(1), short), F.slice(h, F.lit(1 + step), short), lambda a, b: F.xxhash64(a, b))
    return _let(wider, lambda x: _windows(x, span + step, width))


def _covered(hashes: Column, width: int) -> Column:
    """Words inside the windows whose hash stands twice or more, each word once."""
    placed = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    again = _let(placed, lambda s: F.filter(
        s, lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))))
    at = F.sort_array(F.transform(again, lambda x: x["at"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(at, start, lambda a, p: F.struct(
        (a["n"] + width - F.greatest(a["upto"] - p, F.lit(0))).alias("n"), (p + width).alias("upto")),
        lambda a: a["n"])


def with_measures(docs: DataFrame, text: str = "text", width: int = WINDOW) -> DataFrame:
    """`docs` with `text` (null: empty), its arrays of `words` and of `lines` with a word, and the counts `n_words`,
    `word_chars` (code points in words), `n_symbols`, `n_lines`, `n_dup_lines` (equal to an earlier one) and
    `n_repeat_words` (in a window of `width` words found twice or more).

    Windows are compared by a 64-bit hash. A window can only stand twice if its first half
    does; most texts have no such half, which a distinct count shows, and their windows are not made.
    """
    if width < 1:
        raise ValueError("a window has one word at least")
    half = max(1, width // 2)
    rows = docs.withColumn(text, F.coalesce(F.col(text), F.lit(""))).withColumns({
        "words": words_of(F.col(text)),
        "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))})
    rows = rows.withColumn("__half", _let(F.transform("words", lambda w: F.xxhash64(w)),
                                          lambda h: _windows(h, 1, half)))
    again = F.size(F.array_distinct("__half")) < F.size("__half")
    return rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": count_of(F.col(text), SYMBOLS).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.when(again, _covered(_windows(F.col("__half"), half, width), width))
                           .otherwise(0).cast("long")}).drop("__half")


def base_rules() -> dict[str, Column]:
    """Rules on the counts alone."""
    return {"few_words": F.col("n_words") < 20,
            "repeated_words": 100 * F.col("n_repeat_words") > 30 * F.col("n_words")}


def text_rules(text: str = "text") -> dict[str, Column]:
    """Further rules: name -> failure condition on the measured rows."""
    t, n, chars = F.col(text), F.col("n_words"), F.col("word_chars")
    share = lambda test: 100 * F.size(F.filter("lines", test))
    return {
        "symbols": 10 * F.col("n_symbols") > n,
        "duplicate_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "word_length": (chars < 2 * n) | (chars > 15 * n),
        "few_letters": 100 * count_of(t, NO_LETTERS) > 50 * chars,
        "capitals": 100 * count_of(t, CAPITALS) > 40 * chars,
        "bullets": share(lambda x: x.rlike(r"^\s*[-*\u2022]\s")) > 90 * F.col("n_lines"),
        "ellipses": share(lambda x: x.rlike(r"(\.\.\.|\u2026)\s*$")) > 30 * F.col("n_lines"),
        "placeholder": F.lower(t).contains("lorem ipsum"),
    }


@dataclass(frozen=True)
class Estimate:
    """A rule's figures on the sample: seconds beyond reading it, share of rows that fail."""
    name: str
    seconds: float
    rejects: float

    @property
    def rank(self) -> float:
        return self.rejects / max(self.seconds, LEAST_SECONDS)


def estimate_rules(docs: DataFrame, rules: dict[str, Column], sample_rows: int = SAMPLE_ROWS,
                   seed: int = SAMPLE_SEED, repeats: int = 2) -> list[Estimate]:
    """Cost and selectivity of each rule on about `sample_rows` whole rows of `docs` (`text`).

    The sample is measured and written once, by a row's chance and not by its key, so repeated keys
    do not swell it. Each rule is then one aggregate over it, timed `repeats` times
    (the least counts: the first run also compiles), less the time of an aggregate that reads
    the rows and tries no rule. Rules see the sample's columns: all but `words`. No rows: no estimates.
    """
    n = docs.count()
    if not n:
        return []
    some = docs.sample(fraction=min(1.0, sample_rows / n), seed=seed)
    sample = written(with_measures(some).drop("words"), "quality-sample")
    size = sample.count()
    if not size:
        return []

    def timed(condition: Column) -> tuple[float, int]:
        took = []
        for _ in range(repeats):
            start = time.perf_counter()
            found = sample.agg(F.count_if(condition).alias("n"), F.count("text"), F.count("lines")).first()["n"]
            took.append(time.perf_counter() - start)
        return min(took), found

    floor, _ = timed(F.lit(False))
    out = []
    for name, fails in rules.items():
        seconds, found = timed(fails)
        out.append(Estimate(name, max(0.0, seconds - floor), found / size))
    return out


def cascade_order(estimates: list[Estimate], rules: dict[str, Column]) -> list[str]:
    """The rules by rejections per second, most first; ties, and rules without an estimate, as given."""
    rank = {e.name: e.rank for e in estimates}
    return sorted(rules, key=lambda name: -rank.get(name, 0.0))


def cascade(rules: dict[str, Column], order: list[str]) -> Column:
    """The first rule that fails, in `order`; null if none does. A CASE stops at the first condition that
    holds, so what stands behind it is not worked out. A condition that is null does not fail."""
    out = None
    for name in order:
        out = F.when(rules[name], F.lit(name)) if out is None else out.when(rules[name], F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def judge(docs: DataFrame, rules: dict[str, Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`with_measures` of `docs` (`doc_id`, `text`) with `rejected_by`: the rule of the cascade that rejects
    the text, null if it is kept.

    A null text is an empty one and has no words; repeated rows repeat; an empty table
    gives no rows; other columns are not read. A text is measured in one task, its words as an array:
    about 60 bytes a word, whatever the table's size. Which of several failing rules is named depends on
    the measured order; whether one is named does not.
    """
    rules = rules if rules is not None else base_rules() | text_rules()
    docs = docs.select("doc_id", "text")
    order = cascade_order(estimate_rules(docs, rules, sample_rows), rules)
    return with_measures(docs).withColumn("rejected_by", cascade(rules, order))
