"""Toxicity by non-negative positive-unlabelled learning (operator 9).

The confirmed toxic texts are the positives; texts drawn without regard to their labels
are the unlabelled set. With the class prior p, the risk of a scorer f is

    p E+[loss(f)] + max(0, E_u[loss(-f)] - p E+[loss(-f)])

where the second term estimates the risk on the unseen negatives. Where that
estimate is negative (the fit has begun to learn the positives by heart), the
step goes the other way. The scorer is linear over hashed words and
word beginnings, present or not in the whole text, so that one insult counts alike in short and long texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlab.llm.tables import written
from cohortlab.llm.text import mix, row_slices, utf8, word_and_prefix_hashes

BITS = 20                 #: 2^BITS hashed features
PREFIXES = (4, 5, 6, 7, 8)  #: the first bytes of longer words, beside whole words
OFTEN = 3                 #: times a feature stands in a text to count as "often"
MAX_POSITIVE = 2000       #: the fit's sample: confirmed texts, at most (a parameter)
MAX_UNLABELLED = 6000     #: unlabelled texts, at most


def word_features(column, bits: int = BITS, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each text, by row: its distinct hashed words and word
    beginnings, and as a feature of its own each that stands there `OFTEN`
    times. With `used` (a flag per feature) only those."""
    raw, offsets = utf8(column)
    hashes, rows = word_and_prefix_hashes(raw, offsets, PREFIXES)
    shift, low = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
    feats = hashes >> shift
    if used is not None:
        some = used[feats.astype(np.int64)] | used[(mix(feats) >> shift).astype(np.int64)]
        feats, rows = feats[some], rows[some]
    pairs, times = np.unique((rows.astype(np.uint64) << np.uint64(bits)) | feats, return_counts=True)
    again = pairs[times >= OFTEN]
    again = (again & ~low) | (mix(again & low) >> shift)
    pairs = np.unique(np.concatenate([pairs, again]))
    if used is not None:
        pairs = pairs[used[(pairs & low).astype(np.int64)]]
    return (pairs >> np.uint64(bits)).astype(np.int64), (pairs & low).astype(np.int64)


def _bounded(rows: DataFrame, limit: int) -> DataFrame:
    """At most `limit` rows of (doc_id, ..), those with the least hash of doc_id:
    a top-k that keeps `limit` rows per task, not a sort of the table."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sample_features(docs: DataFrame, labels: DataFrame, learnable, max_positive: int = MAX_POSITIVE,
                    max_unlabelled: int = MAX_UNLABELLED, bits: int = BITS) -> tuple[DataFrame, float | None]:
    """(table of `doc_id`, `positive`, `features` of the sampled texts, class prior).

    `learnable(doc_id column)` says which rows may be learned from. A document
    counts as toxic if any of its labels is 1; the prior is their share among
    the labelled documents (None without labels). Both samples are bounded, by
    hash, and written to the shared folder: a long text's features stay there.
    """
    judged = (labels.where("toxic is not null and doc_id is not null").where(learnable(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    prior = judged.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    toxic = _bounded(judged.where("toxic > 0").select("doc_id"), max_positive)
    plain = _bounded(docs.select("doc_id").where("doc_id is not null").where(learnable(F.col("doc_id"))).distinct(),
                     max_unlabelled)
    wanted = toxic.withColumn("positive", F.lit(True)).unionByName(plain.withColumn("positive", F.lit(False)))
    # bounded by the two limits, whatever the tables' size
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select(
        "doc_id", "positive", F.xxhash64("text").alias("hash"), "text")

    def run(batches):
        for b in row_slices(batches, "text"):
            rows, feats = word_features(b.column("text"), bits)
            parts = np.split(feats, np.searchsorted(rows, np.arange(1, b.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("positive"), b.column("hash"),
                 pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))],
                names=["doc_id", "positive", "hash", "features"])

    rows = texts.mapInArrow(run, "doc_id bigint, positive boolean, hash bigint, features array<int>")
    # a repeated id gives one row, of the least text hash; texts themselves are neither sorted nor moved
    once = rows.groupBy("doc_id", "positive").agg(F.min(F.struct("hash", "features")).alias("row"))
    return written(once.select("doc_id", "positive", "row.features"), "toxicity-sample"), prior


def train(docs: DataFrame, labels: DataFrame, learnable, default_prior: float = 0.1,
          bits: int = BITS, **limits) -> "Classifier":
    """The classifier of `docs` (doc_id, text) and `labels` (doc_id, toxic).

    Spark counts in how many sampled texts each feature stands; the driver gets
    those counts (2^`bits` features at most) and, per sampled text, only the few
    features in use. Without positives or texts the scorer stays at the prior.
    """
    sample, prior = sample_features(docs, labels, learnable, bits=bits, **limits)
    model = Classifier(bits, default_prior if prior is None else prior)
    size = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if len(size) < 2:
        return model
    counts = (sample.select("positive", F.explode("features").alias("f")).groupBy("f").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))).toArrow()
    df_p, df_u = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    df_p[counts["f"].to_numpy()], df_u[counts["f"].to_numpy()] = counts["p"].to_numpy(), counts["u"].to_numpy()
    used = model.screen(df_p, df_u, size[True], size[False])
    features = np.flatnonzero(used).astype(np.int32)

    def run(batches):
        for b in batches:
            kept = [np.intersect1d(x.values.to_numpy(), features) if x.is_valid else features[:0]
                    for x in b.column("features")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("positive"), pa.array(kept, pa.list_(pa.int32()))],
                                             names=["doc_id", "positive", "features"])

    rows = sample.mapInArrow(run, "doc_id bigint, positive boolean, features array<int>").toArrow()
    rows = rows.take(pa.array(np.argsort(rows["doc_id"].to_numpy(), kind="stable")))  # reruns agree
    sets: tuple[list, list] = ([], [])
    for p, x in zip(rows["positive"].to_pylist(), rows["features"].combine_chunks()):
        sets[0 if p else 1].append(x.values.to_numpy())
    return model.descend(*sets, used, df_p, df_u)


class Classifier:
    """Weights over hashed features and a bias; the fit is the nnPU estimator."""

    def __init__(self, bits: int = BITS, prior: float = 0.5):
        self.bits = bits
        self.weights = np.zeros(1 << bits, np.float32)
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        self.prior, self.bias = prior, float(np.log(prior / (1 - prior)))

    def fit(self, positive, unlabelled) -> "Classifier":
        """From the texts' feature sets at hand; nothing to learn from: no change."""
        if not positive or not unlabelled:
            return self
        df = [np.bincount(np.concatenate(x), minlength=len(self.weights)) for x in (positive, unlabelled)]
        used = self.screen(*df, len(positive), len(unlabelled))
        return self.descend([s[used[s]] for s in positive], [s[used[s]] for s in unlabelled], used, *df)

    def screen(self, df_p, df_u, n_p: int, n_u: int, least_df: int = 5, least_z: float = 6.0,
               least_rate: float = 0.02, least_share: float = 0.4) -> np.ndarray:
        """Flags of the features that take part: at least `least_df` texts and a share `least_rate`
        of the positives have them, they are more frequent among the positives by
        `least_z` standard errors, and their share of positives, estimated from
        the prior and the two rates, is `least_share` or more. Others would add
        their noise up over a long text."""
        mean = (df_p + df_u) / (n_p + n_u)
        error = np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / n_p + 1 / n_u))
        rate_p, rate_u = df_p / n_p, df_u / n_u
        return ((rate_p >= least_rate) & (rate_p - rate_u >= least_z * error)
                & (self.prior * rate_p >= least_share * rate_u) & (df_p + df_u >= least_df))

    def descend(self, positive, unlabelled, used, df_p, df_u, steps: int = 1500, rate: float = 0.05,
                decay: float = 1e-5) -> "Classifier":
        """Adam on the non-negative risk over sets of used features. Weights are 0
        or more: no innocent word takes an insult back."""
        features = np.flatnonzero(used)
        n_p, n_u = len(positive), len(unlabelled)
        # A feature's value: how far the two rates lie apart, as a log ratio.
        value = np.abs(np.log((df_p[features] + 0.5) / (n_p + 1) / ((df_u[features] + 0.5) / (n_u + 1))))
        sets = [np.searchsorted(features, x) for x in (*positive, *unlabelled)]
        w, b = np.zeros(len(features)), self.bias
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        cols = np.concatenate(sets).astype(np.int64)
        line = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        for t in range(1, steps + 1):
            f = np.bincount(line, weights=(w * value)[cols], minlength=len(sets)) + b
            fp, fu = f[:n_p], f[n_p:]
            # sigmoid loss, bounded, so that no far-out positive outweighs the rest:
            # loss(f) = sigmoid(-f), slope -sigmoid(f) sigmoid(-f)
            negative_risk = sigmoid(fu).mean() - self.prior * sigmoid(fp).mean()
            steep_p, steep_u = sigmoid(fp) * sigmoid(-fp), sigmoid(fu) * sigmoid(-fu)
            up = -self.prior * steep_p / n_p
            down_p, down_u = -self.prior * steep_p / n_p, steep_u / n_u
            slope = (np.concatenate([up + down_p, down_u]) if negative_risk >= 0
                     else -np.concatenate([down_p, down_u]))
            g = np.bincount(cols, weights=slope[line], minlength=len(w)) * value + decay * w
            gb = slope.sum()
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
            np.maximum(w, 0, out=w)
        self.weights[features], self.bias = w * value, float(b)
        return self

    def scores(self, column) -> np.ndarray:
        rows, feats = word_features(column, self.bits, self.weights != 0)
        f = np.bincount(rows, weights=self.weights[feats], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def score_toxicity(docs: DataFrame, model: Classifier, threshold: float = 0.3) -> DataFrame:
    """(`doc_id`, `score`, `predicted`) per row of `docs`, over its whole text.

    `score` is the estimated probability of label 1; a null, empty or wordless
    text gets the model's score without words. Repeated rows repeat;
    an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 4 * 2^BITS bytes, whatever the tables' size

    def run(batches):
        for b in row_slices(batches, "text"):
            s = shared.value.scores(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, predicted int")
