"""URL filter by a ratio of character language models (operator 5).

Rules decide the URLs they fit. For the rest, two Markov models of variable
order, one of accepted and one of rejected URLs, give the log-likelihood of
the URL's bytes; their difference per byte is compared with a threshold that
is calibrated on rule-judged URLs kept out of the models' counts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from cohortlab.llm.tables import written
from cohortlab.llm.text import mix, row_slices, utf8

#: host, path and verdict of each rule; the longest fitting one wins.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
ORDER = 4                 #: bytes of context, at most
CALIBRATION = 5           #: one in so many rule-judged URLs calibrates the threshold
SLICE_BYTES = 1 << 18     #: URLs that are scored together
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: str = "url") -> tuple[Column, Column]:
    """(host, path) expressions: both empty for null and where `://` is missing."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge_by_rules(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) expressions over columns `host` and `path`; null where none fits.
    Of equally long rules the first listed wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):  # shortest first, later ones override
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _grams(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context hash, hash of context and byte) of every byte with `order` bytes of
    context; places before the start count as byte 0."""
    n = len(raw)
    into = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    context = np.full(n, order + 1, np.uint64)
    for back in range(order, 0, -1):
        byte = np.zeros(n, np.uint64)
        byte[back:] = raw[:n - back] if back else raw
        byte[into < back] = 0
        context = context * _STEP + byte + np.uint64(1)
    return mix(context), mix(context * _STEP + raw + np.uint64(7))


def count_grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(`class`, `context`, `gram`, `n`) over all rows of `urls` (class, url): counted per
    slice, summed by Spark, so that a very common host is one row per task."""
    def run(batches):
        for b in row_slices(batches, "url", 1 << 20):
            raw, offsets = utf8(b.column("url"))
            kinds = np.repeat(b.column("class").to_numpy(zero_copy_only=False), np.diff(offsets))
            for k in range(order + 1):
                context, gram = _grams(raw, offsets, k)
                for c in np.unique(kinds):
                    own = kinds == c
                    found, first, n = np.unique(gram[own], return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), c, np.int32)), pa.array(context[own][first].view(np.int64)),
                         pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["class", "context", "gram", "n"])

    return (urls.select("class", "url").mapInArrow(run, "class int, context bigint, gram bigint, n bigint")
            .groupBy("class", "context", "gram").agg(F.sum("n").alias("n")))


class UrlModel(NamedTuple):
    """Exact counts of both models as written tables, keyed by the full 64-bit hashes."""

    order: int
    grams: DataFrame        #: `gram`, `n0`, `n1`: how often it stands in rejected and in accepted URLs
    contexts: DataFrame     #: `context`, `seen0`, `seen1`, `kinds0`, `kinds1` (of next bytes)
    threshold: float = 0.0


def train(judged: DataFrame, order: int = ORDER) -> UrlModel:
    """The model of `judged` (url, class: 1 accepted, 0 rejected).

    All rows count, but one in `CALIBRATION` (by a hash of the URL), which set the
    threshold: the score with the greatest balanced accuracy. The counts grow with the
    distinct n-grams and stay in Spark; the driver holds a histogram of 2,001 scores,
    whatever the number of URLs. With one class empty the scores of the other decide
    nothing: threshold 0.
    """
    rows = judged.where("url is not null").select("class", "url")
    aside = F.pmod(F.xxhash64("url"), F.lit(CALIBRATION)) == 0
    of = lambda c: F.coalesce(F.sum(F.when(F.col("class") == c, F.col("n"))), F.lit(0))
    grams = written(count_grams(rows.where(~aside), order).groupBy("context", "gram")
                    .agg(of(0).alias("n0"), of(1).alias("n1")), "url-grams")
    contexts = written(grams.groupBy("context").agg(
        *[F.sum(f"n{c}").alias(f"seen{c}") for c in (0, 1)],
        *[F.count_if(F.col(f"n{c}") > 0).alias(f"kinds{c}") for c in (0, 1)]), "url-contexts")
    model = UrlModel(order, grams.select("gram", "n0", "n1"), contexts)
    kept = score_urls(rows.where(aside), model, ("class",))
    steps = kept.groupBy("class", F.round(F.greatest(F.lit(-5.0), F.least(F.lit(5.0), "score")) * 200).cast("int")
                         .alias("step")).count().collect()
    total = {c: sum(r["count"] for r in steps if r["class"] == c) for c in (0, 1)}
    if all(total.values()):
        below = {c: np.zeros(2002) for c in (0, 1)}
        for r in steps:
            below[r["class"]][r["step"] + 1001] += r["count"] / total[r["class"]]
        gain = np.cumsum(below[0]) - np.cumsum(below[1])  # rejected below less accepted below each step
        best = np.flatnonzero(gain >= gain.max() - 1e-12)
        model = model._replace(threshold=float((best[len(best) // 2] - 1001 + 0.5) / 200))
    return model


def _in_slices(urls: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of `urls`, one of them url, and the `slice` a row is in, written."""
    def run(batches):
        base = TaskContext.get().partitionId() << 40
        for at, b in enumerate(row_slices(batches, "url", SLICE_BYTES)):
            yield b.append_column("slice", pa.array(np.full(b.num_rows, base + at, np.int64)))

    fields = ", ".join(f"`{c}` {urls.schema[c].dataType.simpleString()}" for c in columns)
    return written(urls.select(*columns).mapInArrow(run, f"{fields}, slice bigint"), "url-slices")


def gram_ratios(slices: DataFrame, model: UrlModel) -> DataFrame:
    """(`gram`, `ratio`): log-likelihood under accepted less that under rejected of every
    distinct n-gram of full order in `slices` (url, slice).

    A byte's estimate depends on its n-gram alone, so each is made once, from that of the
    n-gram a byte shorter. A gram stands once in its join, a context or shorter gram at
    most 256 times: no key is hot, however common its n-gram is.
    """
    order = model.order

    def run(batches):
        for b in row_slices(batches, "url", 1 << 20):
            raw, offsets = utf8(b.column("url"))
            shorter = np.zeros(len(raw), np.uint64)
            for k in range(order + 1):
                context, gram = _grams(raw, offsets, k)
                found, first = np.unique(gram, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), k, np.int32)),
                     *[pa.array(x.view(np.int64)) for x in (found, context[first], shorter[first])]],
                    names=["level", "gram", "context", "shorter"])
                shorter = gram

    need = (slices.select("url").mapInArrow(run, "level int, gram bigint, context bigint, shorter bigint")
            .groupBy("level", "gram").agg(F.first("context").alias("context"), F.first("shorter").alias("shorter")))
    known = written(need.join(model.grams, "gram", "left").join(model.contexts, "context", "left"), "url-known")
    p = None
    for k in range(order + 1):  # Witten-Bell: unseen contexts hand on the shorter one's estimate
        at = known.where(F.col("level") == k)
        if k:
            at = at.join(p.withColumnRenamed("gram", "shorter"), "shorter")
        rest = [F.col(f"p{c}") if k else F.lit(1 / 256) for c in (0, 1)]
        p = at.select("gram", *[F.when(F.col(f"seen{c}") > 0, (F.coalesce(f"n{c}", F.lit(0)) + F.col(f"kinds{c}") * rest[c])
                                       / (F.col(f"seen{c}") + F.col(f"kinds{c}"))).otherwise(rest[c]).alias(f"p{c}")
                                for c in (0, 1)])
    return written(p.select("gram", (F.log("p1") - F.log("p0")).alias("ratio")), "url-ratios")


def score_urls(urls: DataFrame, model: UrlModel, keys: tuple[str, ...]) -> DataFrame:
    """The key columns and `score` per row of `urls`: log-likelihood under accepted less
    that under rejected, per byte (0 for no bytes).

    Each slice of URLs meets the ratios of its distinct n-grams, so that the most common
    one is a row per slice.
    """
    order = model.order
    slices = _in_slices(urls, list(dict.fromkeys([*keys, "url"])))

    def run(batches):
        for b in row_slices(batches, "url", SLICE_BYTES):
            ids = b.column("slice").to_numpy()
            for one in np.unique(ids):
                raw, offsets = utf8(b.column("url").filter(pa.array(ids == one)))
                found = np.unique(_grams(raw, offsets, order)[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), one, np.int64)),
                                                  pa.array(found.view(np.int64))], names=["slice", "gram"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        column = left.column("url").combine_chunks()
        raw, offsets = utf8(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
        sizes = np.diff(offsets)
        grams, ratios = right.column("gram").to_numpy(), right.column("ratio").to_numpy()
        by = np.argsort(grams)
        ratio = ratios[by][np.searchsorted(grams[by], _grams(raw, offsets, order)[1].view(np.int64))]
        total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=ratio, minlength=len(sizes))
        return left.select(list(keys)).append_column("score", pa.array(total / np.maximum(sizes, 1)))

    wanted = slices.select("slice", "url").mapInArrow(run, "slice bigint, gram bigint").distinct()
    ratios = wanted.join(gram_ratios(slices, model), "gram").select("slice", "gram", "ratio")
    fields = ", ".join(f"`{k}` {urls.schema[k].dataType.simpleString()}" for k in keys)
    return (slices.groupBy("slice").cogroup(ratios.groupBy("slice"))
            .applyInArrow(score, f"{fields}, score double"))


def filter_urls(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """(`page_id`, `host`, `path`, `rule`, `verdict`, `score`) per row of `pages`.

    The models learn from all rule-judged URLs of `pages`. A URL no rule fits is
    allowed at a score above the threshold, or if nothing could be learned
    (a null URL scores 0). Repeated rows repeat and are
    counted as often as they stand; an empty table gives no rows; other columns
    are not read.
    """
    rule, verdict = judge_by_rules(rules)
    host, path = split_url()
    judge = lambda t: t.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "says": verdict})
    urls = pages.select("page_id", "url")
    known = judge(urls).where("says is not null").select("url", (F.col("says") == "allow").cast("int").alias("class"))
    model = train(known, order)
    scored = judge(score_urls(urls, model, ("page_id", "url")))
    by_model = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("says", by_model).alias("verdict"), "score")
