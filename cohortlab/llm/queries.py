"""The registered queries of the thirteen operators and of the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortlab.llm import (archive, audit, chat, decontam, langid, mixing, quality, rabitq, secrets, simhash, toxicity,
                           urlfilter, whitening)
from cohortlab.llm.ship import ship_package
from cohortlab.llm.tables import written
from cohortlab.session import ensure_checkpoint_dir, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def language_samples(docs: DataFrame) -> dict[str, str]:
    """What may be learned: rows whose fold of 5 is not 0."""
    return langid.learn_samples(docs.where(crc_fold(F.col("doc_id"), 5) != 0))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_samples(docs))
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


_ODD = r"\\### Assistant: </turn> ok"  # as SQL text: one backslash


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.sql(f"SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{_ODD}' AS text "
                    "FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    back = chat.read_back(chat.format_conversations(talk.unionByName(odd), chat.streamed_events))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda f: f["kind"] != "guess")
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda f: F.concat_ws(":", f["kind"], f["span_start"], f["span_end"])), ",")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed("findings").alias("spans"), count("guess").alias("n_guess"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(_table(spark, sf_dir, "pages"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_repeats")).alias("taken"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = written(rabitq.build_index(_table(spark, sf_dir, "embeddings")), "codes")
    return rabitq.search(index, index.where("vec_id % 50 = 0"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = scratch_path(spark, "archive")
    archive.write_archive(pages, path)
    return archive.read_archive(spark, path)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, lambda c: crc_fold(c, 4) != 2)
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), width=3, max_distance=2)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    base = quality.base_rules()
    base_failed = base["few_words"] | base["repeated_words"]
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_chat_format, op3_secret_scan, op4_decontaminate,
                                    op5_url_filter, op6_mix_sources, op7_vector_search, op8_warc, op9_toxicity,
                                    op10_simhash_dedup, op11_filter_audit, op12_whitening, op13_quality_rules, pipeline)}


_ESC = r"replace(replace(replace({0}, '\', '\b'), '###', '\h'), '</turn>', '\t')"

CHAT_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(4 + length(replace({_ESC.format('role')}, ':', '\c')) + 2 + length({_ESC.format('text')}) + 9) AS formatted
  FROM t GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars
FROM s"""

_WORDS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"""

DECONTAM_SQL = rf"""
WITH iw AS (SELECT DISTINCT item_id, text, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, w, least(5, len(w)) AS k FROM iw WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
      FROM i, unnest(range(1, len(w) - k + 2)) AS u(p)),
n AS (SELECT item_id, count(*) AS n FROM g GROUP BY item_id),
d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format('text')} AS w FROM documents),
h AS (SELECT DISTINCT r, doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
      FROM d, (SELECT DISTINCT k FROM i) AS ks, unnest(range(1, len(w) - k + 2)) AS u(p)),
m AS (SELECT r, doc_id, item_id, count(*) AS m FROM h JOIN g USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, m / n AS containment, CAST(m AS INTEGER) AS n_found, CAST(n AS INTEGER) AS n_shingles
FROM m JOIN n USING (item_id) WHERE m >= 0.8 * n - 1e-9"""

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('20:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY source, key) AS nth FROM d),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
        source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM z),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
        row_number() OVER f AS rank FROM w WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)),
p AS (SELECT source, source_size,
        least(cap, coalesce((SELECT min_by(level, rank) FROM l WHERE cap / weight > level) * weight, cap)) AS target
      FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM p),
k AS (SELECT source, key, sum(size) AS size FROM d GROUP BY source, key),
c AS (SELECT source, key, sum(size) OVER (PARTITION BY source ORDER BY key) - size AS before FROM k)
SELECT n.doc_id, n.size, q.source_size, q.target, CAST(n.size * least(2, q.whole
    + CASE WHEN c.before + (n.nth - 0.5) * n.size <= q.target - q.whole * q.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM n JOIN q ON n.source IS NOT DISTINCT FROM q.source
JOIN c ON n.source IS NOT DISTINCT FROM c.source AND n.key = c.key"""

_DOT = "list_reduce([0.0::DOUBLE] || list_transform(list_zip({0}, {1}), lambda z: z[1] * z[2]), lambda a, b: a + b)"

VECTOR_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
        list_inner_product(q.e, c.e) / sqrt(list_inner_product(q.e, q.e) * list_inner_product(c.e, c.e)) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(CAST(encode(html) AS BLOB)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f"""


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
         regexp_matches(text, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
      FROM o, unnest(range(1, 6)) AS u(step)),
y AS (SELECT part, filter_order, step, letter, n, good, toxic,
        fails[ascii(letter) - 64] AS failing,
        len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda k: fails[ascii(k) - 64])) AS n_failing,
        len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda k: fails[ascii(k) - 64] AND contains(before, k))) > 0 AS gone
      FROM c, s),
z AS (SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0) AS kept,
        coalesce(sum(n) FILTER (failing AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (failing AND gone), 0) AS redundant,
        coalesce(sum(n) FILTER (failing AND n_failing = 1), 0) AS unique_fails,
        coalesce(sum(n) FILTER (failing AND NOT gone AND good), 0) AS good_lost,
        coalesce(sum(n) FILTER (failing AND NOT gone AND toxic), 0) AS toxic_lost
      FROM y GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM z"""


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, p, array_to_string(words[p:p + 7], ' ') AS g FROM w, unnest(range(1, len(words) - 6)) AS u(p)),
t AS (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS times FROM g),
c AS (SELECT r, count(DISTINCT q) AS n FROM t, unnest(range(p, p + 8)) AS u(q) WHERE times > 1 GROUP BY r),
m AS (SELECT doc_id, text, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 100 * length(regexp_replace(text, '[^0-9[:punct:]]+', '', 'g')) > 50 * word_chars
    OR 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 40 * word_chars
    OR 100 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•][\x20\x09-\x0D]'))) > 90 * n_lines
    OR 100 * len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\x09-\x0D]*$'))) > 30 * n_lines
    OR contains(lower(text), 'lorem ipsum')) AS kept
FROM b"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the others are tested against brute force."""
    return {"op2_chat_format": CHAT_SQL, "op4_decontaminate": DECONTAM_SQL, "op6_mix_sources": MIX_SQL,
            "op7_vector_search": VECTOR_SQL, "op8_warc": WARC_SQL, "op11_filter_audit": AUDIT_SQL,
            "op13_quality_rules": QUALITY_SQL}
