"""Filter interaction audit by incremental retraction streaming (operator 11).

The document files are a stream that is read to its end in micro-batches
(`availableNow`). Each row gets a mask, one bit per filter it fails. Whether a
text repeats a smaller doc_id's is known only from the texts seen so far: keyed
state holds, per text, the least id and what was counted for it. When a smaller
id arrives, the earlier mask is taken back from the counters (a count below
zero) and counted anew with the duplicate bit. The counters are sums of these
changes; every order of the filters is then arithmetic on 2^filters masks.
"""

from __future__ import annotations

import json
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cohortlab.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
ROUNDS = 4             #: micro-batches that a run over all files takes
TEXTS_PER_KEY = 256    #: texts that share a state key (a hash range), on average
#: RocksDB keeps state on the executors' disks; its change logs go to the shared checkpoint folder.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else MBs are set aside per state partition
}
FIRST, LATER, VOID = 0, 1, 2
_CHANGE = "part string, mask int, good boolean, toxic boolean, n bigint"


def content_filters(text: Column) -> dict[str, Column]:
    """The filters that one text decides: letter -> failure condition. `text` is not null."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n_words = F.size(words)
    return {"A": n_words < 50,
            "B": 100 * F.size(F.array_distinct(words)) < 65 * n_words,
            "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def masked(docs: DataFrame, filters=content_filters) -> DataFrame:
    """Per row: `doc_id`, `part` (source, null: empty), `mask` (bit i: fails the
    i-th content filter) and the text's SHA-256, of which 128 bits are kept."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters(text).values())]
    digest = F.sha2(text, 256)
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       sum(bits[1:], bits[0]).alias("mask"), half(1).alias("hi"), half(17).alias("lo"))


def label_flags(labels: DataFrame) -> DataFrame:
    """One row per labelled doc_id: `good` (any quality 1), `toxic` (any toxic 1)."""
    flag = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    return (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
            .agg(flag("quality").alias("good"), flag("toxic").alias("toxic")))


def _combine(batches):
    """One Arrow batch's rows, summed before they are shuffled: rows with their text's least id in
    the batch stay apart by id (`FIRST`); the others repeat a smaller id for sure (`LATER`) or
    have none (`VOID`), and their id goes. However many copies a text has, it sends a few rows per batch."""
    for b in batches:
        t = pa.Table.from_batches([b]).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        if t.empty:
            continue
        least = t.groupby(["hi", "lo"])["doc_id"].transform("min")
        later = (t["doc_id"] > least).fillna(False).to_numpy(bool)
        t["kind"] = np.where(t["doc_id"].isna(), VOID, np.where(later, LATER, FIRST)).astype(np.int32)
        t["doc_id"] = t["doc_id"].where(t["kind"] == FIRST, 0)
        keys = ["bucket", "hi", "lo", "doc_id", "part", "mask", "good", "toxic", "kind"]
        t = t.groupby(keys, sort=False).size().rename("n").reset_index()
        yield pa.RecordBatch.from_pandas(t, schema=_COMBINED, preserve_index=False)


_COMBINED = pa.schema([("bucket", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()),
                       ("part", pa.string()), ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()),
                       ("kind", pa.int32()), ("n", pa.int64())])
_COMBINED_DDL = ("bucket bigint, hi bigint, lo bigint, doc_id bigint, part string, mask int, good boolean, "
                 "toxic boolean, kind int, n bigint")
_SEEN = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("part", pa.string()),
                   ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64())])


def _pack(seen: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pandas(seen, schema=_SEEN, preserve_index=False)
    with pa.ipc.new_stream(sink, _SEEN) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(state: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(state) as read:
        return read.read_all().to_pandas()


def changes(seen: pd.DataFrame | None, new: pd.DataFrame, duplicate: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(what is kept per text, the counters' changes) after the rows `new`.

    `seen` has the rows of each text's least id. A new row of a larger id
    counts with the duplicate bit, one of the least id without; where the least id
    falls, the rows seen for the earlier one are taken back and counted with the bit.
    Rows of one id and text are no copies of each other; a row without an id is
    compared with none.
    """
    cell = ["part", "mask", "good", "toxic"]
    sure = new[new["kind"] == LATER].assign(mask=lambda t: t["mask"] | duplicate)[[*cell, "n"]]
    alone = new[new["kind"] == VOID][[*cell, "n"]]
    fresh = new[new["kind"] == FIRST].assign(old=False)
    rows = fresh if seen is None else pd.concat([seen.assign(old=True), fresh], ignore_index=True)
    first = rows["doc_id"] == rows.groupby(["hi", "lo"])["doc_id"].transform("min")
    back = rows[rows["old"] & ~first]
    counted = rows[~rows["old"] | ~first]
    counted = counted.assign(mask=counted["mask"].where(first[counted.index], counted["mask"] | duplicate))
    change = pd.concat([sure, alone, back.assign(n=-back["n"])[[*cell, "n"]], counted[[*cell, "n"]]])
    change = change.groupby(cell, as_index=False, sort=False)["n"].sum()
    kept = rows[first].groupby(["hi", "lo", "doc_id", *cell], as_index=False, sort=False)["n"].sum()
    return kept, change[change["n"] != 0]


def retracting_counts(docs: DataFrame, labels: DataFrame, buckets: int, filters=content_filters) -> DataFrame:
    """The stream of counter changes (`part`, `mask`, `good`, `toxic`, `n`) of a stream of documents.

    State is keyed by ranges of the texts' digests, `buckets` of them (fixed for a
    stream's life), and only touched keys are rewritten.
    """
    duplicate = 1 << len(filters(F.lit("")))
    rows = masked(docs, filters)
    # rows without an id meet no label; the salt spreads them
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod("hi", F.lit(4096))).otherwise(0))
    flags = label_flags(labels).withColumn("zero", F.lit(0).cast("long"))
    joined = rows.join(flags, (F.col("doc_id") == F.col("label_id")) & (F.col("salt") == F.col("zero")), "left")
    joined = joined.select(F.pmod("lo", F.lit(buckets)).alias("bucket"), "hi", "lo", "doc_id", "part",
                           F.col("mask").cast("int").alias("mask"), F.coalesce("good", F.lit(False)).alias("good"),
                           F.coalesce("toxic", F.lit(False)).alias("toxic"))

    def update(key, frames, state):
        seen = _unpack(state.get[0]) if state.exists else None
        out = []
        for new in frames:
            seen, change = changes(seen, new, duplicate)
            out.append(change)
        state.update((_pack(seen),))
        yield pd.concat(out).astype({"mask": np.int32})

    return (joined.mapInArrow(_combine, _COMBINED_DDL).groupBy("bucket")
            .applyInPandasWithState(update, _CHANGE, "texts binary", "append", GroupStateTimeout.NoTimeout))


def _streamable(path: str) -> str:
    """The path as a glob that matches it alone: a file source takes a folder or a glob, not one file."""
    return f"{path[:-1]}[{path[-1]}]"


def part_counters(spark: SparkSession, path: str, labels: DataFrame, rounds: int = ROUNDS,
                  texts_per_key: int = TEXTS_PER_KEY, filters=content_filters,
                  folder: str | None = None) -> DataFrame:
    """(`part`, `mask`, `good`, `toxic`, `n`) of the Parquet documents at `path`, read as a stream.

    `folder` (in the shared folder if not given) keeps the changes and the stream's checkpoint: run
    again with one, only files that came since are read. A lost executor's state is
    rebuilt from the change logs there.
    """
    table = spark.read.parquet(path)
    buckets = max(1, table.count() // texts_per_key)
    folder = folder or scratch_path(spark, "audit")
    each = max(1, -(-len(table.inputFiles()) // rounds))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", each).parquet(_streamable(path))
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():  # a query takes the settings it is started with
            spark.conf.set(k, v)
        query = (retracting_counts(stream, labels, buckets, filters).writeStream.format("parquet")
                 .option("path", f"{folder}/changes").option("checkpointLocation", f"{folder}/checkpoint")
                 .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    written = spark.read.schema(_CHANGE).parquet(f"{folder}/changes")
    return (written.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
            .where("n <> 0"))


def filter_orders(letters: str) -> Column:
    """Every order of the filters, step by step, as one array of (filter_order, step, bit, before)."""
    steps = [{"filter_order": "".join(o), "step": i + 1, "bit": 1 << letters.index(f),
              "before": sum(1 << letters.index(x) for x in o[:i])}
             for o in permutations(letters) for i, f in enumerate(o)]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")


def interactions(counters: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Per part, order of the filters and step: what the step's filter keeps and
    removes, what it finds removed already, and its share over all orders.

    A part is one row of 2^filters counts; each order reads its numbers off
    them, so no document is looked at again and no table is joined.
    """
    size = 1 << len(letters)
    totals = counters.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when((F.col("mask") == m) & which, F.col("n"))), F.lit(0)).cast("long")
                  for m in range(size)]).alias(name)
        for name, which in (("all", F.lit(True)), ("good", F.col("good")), ("toxic", F.col("toxic")))])
    rows = totals.select("*", F.explode(filter_orders(letters)).alias("at"))
    bit, before = F.col("at.bit"), F.col("at.before")
    masks = F.array(*[F.lit(m) for m in range(size)])

    def total(counts: str, which, weight=lambda m: F.lit(1)) -> Column:
        terms = F.zip_with(masks, counts, lambda m, n: F.when(which(m), n * weight(m)).otherwise(0))
        return F.aggregate(terms, F.lit(0).cast("long"), lambda a, x: a + x)

    fails = lambda m: m.bitwiseAND(bit) != 0
    here = lambda m: fails(m) & (m.bitwiseAND(before) == 0)
    orders = int(np.prod(range(1, len(letters) + 1)))
    # of the orders, 1 / (filters that a document fails) have this one first among them
    first_of = lambda m: (F.lit(orders) / F.greatest(F.bit_count(m), F.lit(1))).cast("long")
    return rows.select(
        "part", "at.filter_order", "at.step",
        total("all", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("all", here).alias("removed"),
        total("all", lambda m: fails(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("all", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"),
        total("all", fails, first_of).alias("shapley"))


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """`interactions` of the documents at `path`: filters A to D on the text, E the repeated text.

    Null texts are empty texts, equal to each other; a null source is the part
    ''. A null doc_id neither repeats nor is repeated, and rows of one doc_id and
    text do not repeat each other. A document is good or toxic if any of its labels
    says so; null labels say nothing. An empty table gives no rows; other columns
    are not read.
    """
    return interactions(part_counters(spark, path, labels, **options))
