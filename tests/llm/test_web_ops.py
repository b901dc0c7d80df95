"""Operators on pages, conversations and vectors."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortlab.llm import archive, chat, rabitq, urlfilter, warc
from cohortlab.session import scratch_path

SF = "/root/testdata/sf0.001"
EVENTS = "conv_id bigint, seq bigint, msg_id string, event string, role string, text string"


# ---- chat --------------------------------------------------------------------------

def messages(spark, rows):
    out = chat.fold_events(spark.createDataFrame(rows, EVENTS)).collect()
    return [(r["conv_id"], r["role"], r["text"]) for r in sorted(out, key=lambda r: (str(r["conv_id"]), r["position"] or 0))]


def test_events_fold_into_final_messages(spark):
    rows = [(1, 1, "q", "start", "user", "hel"), (1, 2, "q", "delta", None, "lo"),
            (1, 3, "a", "start", "assistant", ""), (1, 4, "a", "delta", None, "bad "), (1, 5, "a", "delta", None, "answer"),
            (1, 7, "a", "regenerate", None, None), (1, 9, "a", "delta", None, "answer"), (1, 8, "a", "delta", None, "good "),
            (1, 10, "q", "edit", None, "hello!"), (1, 8, "a", "delta", None, "good "),  # replayed
            (2, 1, "x", "delta", "user", "no start")]
    assert messages(spark, rows) == [(1, "user", "hello!"), (1, "assistant", "good answer"), (2, "user", "no start")]
    assert messages(spark, []) == []


ODD = ["\\### Assistant: </turn> ok", "\\b\\h\\t\\c\\\\", "####", "##", "</turn>", " </turn>\n### user: x", "</tur", "n>",
       "", None, " ", "\n", "\\", "\\\\h", "a\U0001F600\u00e9\x00b", "### ", "<//turn>"]


def test_round_trip(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a: b", "###", None, "\\c:"]), "".join(
        (rng.choice(ODD) or "") for _ in range(rng.choice((1, 1, 2, 5))))) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(-7, 0, "user", ODD[0]), (-7, 1, "assistant", ODD[0]), (40, 0, "assistant", None), (None, 3, "user", "n"),
             (41, None, "assistant", "x"), (41, 5, "assistant", "y"), (42, 1, "user", "tie b"), (42, 1, "user", "tie a"),
             (43, 1, "user", "z" * 300_000), (42, 1, "user", "tie a")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.read_back(chat.format_conversations(table.withColumn("formatted", F.lit(1)).withColumn("seq", F.lit(1))))
    want = {}
    for c, t, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows),
                                   key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2].encode(), r[3].encode())):
        want.setdefault(c, []).append((role, text))
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert got[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        assert got[c]["formatted"].count(chat.CLOSE) == len(turns)
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_the_last_of_tied_resets_holds(spark):
    rows = [(1, 2, "m", "edit", "user", "A"), (1, 2, "m", "regenerate", "user", "B"), (1, 2, "m", "delta", None, "C"),
            (1, 1, "m", "delta", None, "gone"), (2, None, "m", "start", "user", "gone"), (2, 1, "m", "edit", None, "kept")]
    assert messages(spark, rows) == [(1, "user", "BC"), (2, "user", "kept")]


def test_turns_that_differ_by_a_nulls_place_and_equal_turns(spark):
    rows = [(1, 1, "user", None), (1, 1, None, "user"), (1, 2, "user", "x"), (1, 2, "user", "x"), (1, 2, "user", "x"),
            (1, None, "user", "loose"), (None, 3, "assistant", "a ### b"), (2, 1, "assistant", "odd"), (2, 2, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1))
    for as_log in (chat.turn_events, chat.streamed_events):
        back = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns, as_log)).collect()}
        said = {k: sorted((t["role"], t["text"]) for t in r["turns"]) for k, r in back.items()}
        assert said == {1: sorted([("user", ""), ("", "user"), ("user", "loose")] + [("user", "x")] * 3),
                        None: [("assistant", "a ### b")], 2: [("assistant", ""), ("assistant", "odd")]}
        assert back[2]["loss_text"] == "odd"
    log = chat.streamed_events(turns)
    assert {r["event"] for r in log.select("event").distinct().collect()} == {"start", "delta", "edit", "regenerate"}


def test_chat_query_is_native(spark):
    plan = entry.queries()["op2_chat_format"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---- URLs --------------------------------------------------------------------------

def test_hosts_paths_and_rules(spark):
    cases = {"http://A.Example.COM/en/x?q#f": ("a.example.com", "/en/x", "example.com/en/", "block"),
             "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
             "https://x.www.example.com/en/1": ("x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
             "http://shop.com/": ("shop.com", "/", "com/", "allow"), "http://shop.com": ("shop.com", "", None, None),
             "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
             "x://a.net/fr/": ("a.net", "/fr/", "net/fr/", "block"), "x://a.net/es/?/": ("a.net", "/es/", "net/es/", "block"),
             "x://anet/fr/": ("anet", "/fr/", None, None), "x://com/": ("com", "/", "com/", "allow"),
             "no scheme": ("", "", None, None), "": ("", "", None, None), None: ("", "", None, None),
             "a://b#c://d/": ("b", "", None, None), "://": ("", "", None, None), "x://\u00c9.com/": ("\u00c9.com", "/", "com/", "allow"),
             "x://h\ni.com/\np": ("h\ni.com", "/\np", "com/", "allow")}
    table = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id bigint, url string")
    host, path = urlfilter.split_url()
    rule, says = urlfilter.judge_by_rules()
    out = table.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "says": says})
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["says"]) for r in out.collect()}
    assert got == dict(enumerate(cases.values()))


def brute_score(model_rows, url, order):
    """Witten-Bell estimates from plain dictionaries."""
    def logp(c):
        total, b = 0.0, url.encode()
        for i in range(len(b)):
            p = 1 / 256
            for k in range(order + 1):
                ctx = bytes(b[i - j] if i >= j else 0 for j in range(k, 0, -1)), k
                follow = model_rows[c].get(ctx)
                if follow:
                    n = sum(follow.values())
                    p = (follow.get(b[i], 0) + len(follow) * p) / (n + len(follow))
            total += math.log(p)
        return total
    return (logp(1) - logp(0)) / max(1, len(url.encode()))


def test_model_scores_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(c, f"http://{rng.choice(('good', 'fine') if c else ('spam', 'bad'))}.org/{rng.randrange(99)}")
            for c in (0, 1) for _ in range(200)] + [(1, "")]
    judged = spark.createDataFrame(rows, "class int, url string").repartition(3)
    model = urlfilter.train(judged)
    aside = {r["url"] for r in judged.where(F.pmod(F.xxhash64("url"), F.lit(urlfilter.CALIBRATION)) == 0).collect()}
    counts = {0: {}, 1: {}}
    for c, url in rows:
        b = url.encode()
        for i in range(len(b) if url not in aside else 0):
            for k in range(urlfilter.ORDER + 1):
                ctx = bytes(b[i - j] if i >= j else 0 for j in range(k, 0, -1)), k
                follow = counts[c].setdefault(ctx, {})
                follow[b[i]] = follow.get(b[i], 0) + 1
    urls = ["http://good.org/1", "http://spam.org/1", "http://new.org/", "\u00e9", ""]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: r["score"] for r in urlfilter.score_urls(table, model, ("page_id",)).collect()}
    for i, u in enumerate(urls):
        assert got[i] == pytest.approx(brute_score(counts, u, urlfilter.ORDER), abs=1e-4)
    assert got[1] < model.threshold < got[0]


def test_model_grows_with_the_urls(spark):
    """Millions of distinct n-grams share no count: a new context stays unseen."""
    rng = random.Random(9)
    judged = [(i % 2, "".join(chr(rng.randrange(33, 127)) for _ in range(4000))) for i in range(150)]
    table = spark.createDataFrame(judged, "class int, url string").repartition(4)
    model = urlfilter.train(table)
    got = urlfilter.score_urls(spark.createDataFrame([(1, "\u0434\u0436" * 8)], "page_id bigint, url string"),
                               model, ("page_id",)).head()["score"]
    aside = {r["url"] for r in table.where(F.pmod(F.xxhash64("url"), F.lit(urlfilter.CALIBRATION)) == 0).collect()}
    seen = [{}, {}]
    for c, url in judged:
        for x in url.encode() if url not in aside else b"":
            seen[c][x] = seen[c].get(x, 0) + 1
    # no byte of the URL stands in a judged one: only the empty context and the start's zeros are known
    p = [(len(s) / 256) / (sum(s.values()) + len(s)) for s in seen]
    firsts = [{u.encode()[0] for c, u in judged if c == k and u not in aside} for k in (0, 1)]
    n = [sum(u not in aside for c, u in judged if c == k) for k in (0, 1)]
    start = [p[k] * (len(firsts[k]) / (n[k] + len(firsts[k]))) ** 4 for k in (0, 1)]
    want = (math.log(start[1] / start[0]) + 31 * math.log(p[1] / p[0])) / 32
    assert got == pytest.approx(want, abs=1e-9)


def test_url_edges(spark):
    rows = [(1, None, "h"), (1, None, None), (None, "http://a.com/", ""), (2, "http://b.org/x", None), (2, "http://b.org/x", None),
            (3, "http://c.org/" + "long/" * 300_000, ""), (4, "", ""), (5, "\u00e9\U0001F600://\u00e9/", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit(1))
    out = urlfilter.filter_urls(pages.withColumn("verdict", F.lit("x")).withColumn("class", F.lit(0))).collect()
    assert len(out) == len(rows) and {r["verdict"] for r in out} <= {"allow", "block"}
    assert urlfilter.filter_urls(pages.limit(0)).count() == 0


# ---- vectors -----------------------------------------------------------------------

def brute_nearest(rows, k=5):
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cos(a, b):
        dot = na = nb = 0.0
        for x, y in zip(a, b):
            dot, na, nb = dot + x * y, na + x * x, nb + y * y
        return dot / math.sqrt(na * nb)
    good = [(i, v) for i, v in rows if i is not None and ok(v)]
    out = {}
    for q in sorted({i for i, _ in good if i % 50 == 0}):
        own = min(v for i, v in good if i == q)
        best = {}
        for i, v in good:
            if i != q and len(v) == len(own):
                best[i] = max(best.get(i, -2), cos(own, v))
        out[q] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def test_search_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(400)]
    rows += [(i, rows[100][1]) for i in range(400, 460)]  # a crowd of copies: ties to the smaller id
    rows += [(500, None), (550, []), (600, [0.0] * 24), (650, [float("nan")] * 24), (651, [None] + [1.0] * 23),
             (700, [1.0, 2.0]), (701, [2.0, 1.0]), (702, [float("inf"), 1.0]), (None, [1.0] * 24),
             (3, rows[3][1]), (50, rows[50][1]), (7, rows[8][1]), (750, [1e-200] * 24), (751, [1e200] * 23 + [2e200])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    index = rabitq.build_index(table.withColumn("code", F.lit("x")).repartition(3))
    want = brute_nearest([(i, v) for i, v in rows if i not in (750, 751)])
    for block in (4096, 3):
        got = {}
        for r in sorted(rabitq.search(index, index.where("vec_id % 50 = 0"), block=block).collect(),
                        key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
        assert 750 in got and 600 not in got and [x[0] for x in got[700]] == [701]
        for q, near in want.items():
            near = [x for x in got[q] if x[0] not in (750, 751)]
            if len(near) == 5:
                assert [x[:2] for x in near] == want[q]
            assert [x[2] for x in got[q]] == list(range(1, len(got[q]) + 1))
    assert rabitq.search(index.limit(0), index.limit(0)).count() == 0


def test_estimates_stay_within_their_bound():
    import numpy as np
    x = np.random.default_rng(1).standard_normal((2000, 64))
    turn = rabitq.rotation(64)
    assert turn.shape == (64, rabitq.CODE_BITS) and np.allclose(turn @ turn.T, np.eye(64))
    code, correction = rabitq.encode(x, turn)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    signs = np.unpackbits(code, axis=1).astype(float) * 2 - 1
    estimate = (unit[:20] @ turn) @ signs.T / (16 * correction)
    spread = rabitq.EPSILON * np.sqrt((1 / correction ** 2 - 1) / 255)
    off = ~np.eye(20, 2000, dtype=bool)
    assert (np.abs(estimate - unit[:20] @ unit.T) <= spread)[off].mean() > 0.9995
    assert spread.mean() < 0.25


def test_bit_planes_estimate_the_product():
    """Counts of set bits equal the dot product with the quantised query; the bound holds; odd lengths are padded."""
    import numpy as np
    for d in (1, 64, 300):
        x = np.random.default_rng(2).standard_normal((900, d))
        x[5] = x[7] * 3
        turn = rabitq.rotation(d)
        code, correction = rabitq.encode(x, turn)
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        queries = rabitq.QueryCodes(unit[:40] @ turn)
        got = queries.estimate(slice(3, 40), np.ascontiguousarray(code.view(np.uint64).T), correction)
        bits, levels = turn.shape[1], 1 << rabitq.PLANES
        step = rabitq.STEP / bits ** 0.5
        value = (np.clip(np.floor(unit[3:40] @ turn / step) + levels // 2, 0, levels - 1) - (levels - 1) / 2) * step
        value /= (value * (unit[3:40] @ turn)).sum(axis=1)[:, None]
        signs = np.unpackbits(code, axis=1).astype(float) * 2 - 1
        assert bits % 64 == 0 and np.allclose(got, value @ signs.T / bits ** 0.5 / correction, atol=1e-5)
        if d > 1:
            off = np.abs(got - unit[3:40] @ unit.T) <= queries.spread(correction, rabitq.EPSILON)
            assert off[~np.eye(40, 900, dtype=bool)[3:]].mean() > 0.9995


def test_crowds_near_a_query_are_found():
    """Thousands of vectors almost at the floor, and a query's copies in several batches."""
    import numpy as np
    rng = np.random.default_rng(3)
    base = rng.standard_normal(64)
    x = np.concatenate([base + 0.05 * rng.standard_normal((3000, 64)), rng.standard_normal((3000, 64)),
                        np.repeat(base[None], 20, axis=0)])
    ids = rng.permutation(len(x))
    queries = np.concatenate([np.arange(10), np.arange(3000, 3010), [6019]])
    code, correction = rabitq.encode(x, rabitq.rotation(64))
    group = rabitq._Queries(ids[queries], x[queries], 5, rabitq.SEED)
    for at in np.array_split(np.arange(len(x)), 7):
        group.offer(ids[at], x[at], code[at], correction[at], rabitq.EPSILON)
    got = {}
    for q, v, _ in group.rows():
        got.setdefault(q, []).append(v)
    for q in queries:
        score = rabitq.cosine(np.repeat(x[q][None], len(x), axis=0), x)
        order = [v for v in ids[np.lexsort((ids, -score))] if v != ids[q]]
        assert got[ids[q]] == order[:5]


# ---- WARC --------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"
BIG = "<p>same</p>" * 20


def test_archive_round_trip(spark):
    rows = [(3, "http://a/", BIG), (1, "http://b/\r\nX: y", BIG), (2, None, BIG), (4, "u", "small"), (5, "u", "small"),
            (6, "u", None), (7, "u", ""), (8, "u", "\u00e9" * 60), (9, "u", "x" * 3_000_000), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 9),
            (11, "u", "y" * 99), (12, "u", "y" * 99), (13, "u", "y" * 100), (14, "u", "y" * 100), (None, "u", BIG), (1, "u", BIG)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).withColumn("payload", F.lit("x"))
    path = scratch_path(spark, "t")
    archive.write_archive(pages.repartition(3), path)
    first = {BIG: 1, "y" * 100: 13}
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if first.get(html) != i else None
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    got = archive.read_archive(spark, path)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    empty = scratch_path(spark, "t")
    archive.write_archive(pages.limit(0), empty)
    assert archive.read_archive(spark, empty).count() == 0


class _Bytes:
    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, n, at):
        self.read += n
        return self.data[at:at + n]


def test_predicates_skip_payloads():
    body = random.Random(0).randbytes(4_000_000)
    one = [warc.record_bytes("response", f"<urn:x:{i}>", "http://h/", "1970-01-01T00:00:00Z", None, "d", body, len(body))
           for i in range(3)]
    small = warc.record_bytes("metadata", "<urn:x:9>", None, "1970-01-01T00:00:00Z", None, None, b"note", 4)
    data = b"".join(map(warc.gzip_member, (*one, small)))
    file = _Bytes(data)
    found = list(warc.read_records(warc._Stream(file, len(data)), lambda h: h["warc-type"] == "metadata"))
    assert [h["warc-record-id"] for _, h, _, _ in found] == ["<urn:x:9>"] and found[0][3] == b"note"
    assert file.read < len(data) / 2  # the large payloads were neither read nor inflated
    for plain in (data, b"".join((*one, small)), b"".join(map(lambda r: zlib.compress(r, wbits=31), (*one, small)))):
        records = list(warc.read_records(warc._Stream(_Bytes(plain), len(plain))))
        assert [r[3] for r in records] == [body] * 3 + [b"note"]
        assert records[0][2] == len(body)
    whole = zlib.compress(b"".join((*one, small)), wbits=31)   # one gzip member for all records
    for data in (whole, whole + whole, whole + small):
        file = _Bytes(data)
        found = list(warc.read_records(warc._Stream(file, len(data)), lambda h: h["warc-type"] == "metadata"))
        assert [r[3] for r in found] == [b"note"] * (1 if data is whole else 2) and found[0][0] == 0


def test_broken_archives_are_errors():
    body = random.Random(1).randbytes(3000)
    records = [warc.record_bytes("response", f"<urn:x:{i}>", "http://h/", "1970-01-01T00:00:00Z", None, "d", body, len(body))
               for i in range(6)]

    def read(data, wants=lambda h: True):
        return list(warc.read_records(warc._Stream(_Bytes(data), len(data)), wants, name="a.warc"))

    bad = records[:1] + [b"XARC" + records[1][4:]] + records[2:]
    members = list(map(warc.gzip_member, bad))
    for data, at in ((b"".join(bad), len(records[0])), (b"".join(members), len(members[0])),
                     (zlib.compress(b"".join(bad), wbits=31), 0)):
        for wants in (lambda h: True, lambda h: False):
            with pytest.raises(ValueError, match=f"a.warc: no WARC record at offset {at}$"):
                read(data, wants)
    good = list(map(warc.gzip_member, records))
    for pieces in (records, good, [zlib.compress(b"".join(records), wbits=31)]):
        data = b"".join(pieces)
        assert len(read(data)) == 6 and len(read(data + b"\r\n")) == 6
        for wants in (lambda h: True, lambda h: False):
            with pytest.raises(ValueError, match=r"a.warc: .* at offset \d+"):
                read(data[:len(data) - 900], wants)     # the last record is short
    torn = bytearray(b"".join(good))
    torn[len(good[0]) + 100] ^= 0xFF
    with pytest.raises(ValueError, match=f"a.warc: .* at offset {len(good[0])}"):
        read(bytes(torn))
    without = records[0].replace(b"Content-Length: ", b"Content-Length: x", 1)
    with pytest.raises(ValueError, match="no content length"):
        read(without)
    assert read(b"") == [] and read(b"\r\n\r\n") == []


def test_filters_are_pushed(spark):
    path = scratch_path(spark, "t")
    archive.write_archive(spark.read.parquet(f"{SF}/pages.parquet"), path)
    records = spark.read.format("warc").load(path)
    n = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert records.count() == n + 1 and records.where("record_type = 'warcinfo'").count() == 1
    assert records.where("record_type = 'response' and record_id = '<urn:x-page:3>'").count() == 1
    assert records.where("record_id like '<urn:x-page:1%'").count() == sum(str(i)[0] == "1" for i in range(n))
    assert records.where("record_type in ('response', 'revisit') and payload is null").count() == records.where(
        "record_type = 'revisit'").count()
    assert spark.read.format("warc").option("payload", "none").load(path).where("payload is not null").count() == 0
    reader = warc.WarcReader(path, None)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = [EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5)]
    assert list(reader.pushFilters(left)) == left[1:] and len(reader.tests) == 1
