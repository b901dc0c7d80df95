"""Chat formatting by event-sourced reconstruction (operator 2, DataFrame functions only).

A log of events is folded into final messages: a `start` opens a message, each
`delta` appends a piece of streamed text, an `edit` replaces the text, a
`regenerate` throws the reply so far away. The messages are rendered with a
template whose control strings are escaped inside texts, with a loss mask over
the assistant's words, and can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "### ", " </turn>\n"
#: Control string -> escape, applied in this order; every backslash of an
#: escaped text is followed by the letter of its own code, so the reverse is exact.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
_RESETS = ("start", "edit", "regenerate")
BLOCK = 64   #: sequence numbers whose messages are joined first


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def fold_events(events: DataFrame) -> DataFrame:
    """(`conv_id`, `position`, `role`, `text`) per message of an event log
    (`conv_id`, `seq`, `msg_id`, `event`, `role`, `text`).

    A message's text is what its last start, edit or regenerate brought plus the deltas
    after it, by seq; its place is its first seq, its role the last one named.
    Null texts and roles count as empty; a replayed event (equal in every
    column) counts once; events of one seq go in the order start, edit, regenerate, delta, then by
    text, so that of several resets at one seq the last holds; a null seq stands before all others.
    The group is one message, so no group holds a whole conversation here.
    """
    order = F.array_position(F.array(*[F.lit(e) for e in _RESETS]), F.coalesce("event", F.lit("")))
    piece = F.struct("seq", F.when(order > 0, order).otherwise(len(_RESETS) + 1).alias("order"),
                     F.coalesce("text", F.lit("")).alias("text"))
    folded = events.select("conv_id", "seq", "msg_id", "event", "role", "text").groupBy("conv_id", "msg_id").agg(
        F.min("seq").alias("position"),
        F.max(F.when(order > 0, piece)).alias("reset"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"),
        F.array_sort(F.collect_set(piece)).alias("pieces"))
    live = F.filter("pieces", lambda p: F.col("reset").isNull() | (p >= F.col("reset")))
    text = F.array_join(F.transform(live, lambda p: p["text"]), "")
    return folded.select("conv_id", "position", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """(`conv_id`, `formatted`, `loss_mask`) per conversation.

    `loss_mask` has a struct per turn: of its characters in `formatted`, `skip` are outside the
    loss and the `take` after them inside (assistant texts; 0 for others). Messages are
    ordered by position, ties by role and text. They are escaped and
    rendered row by row, joined per block of `block` sequence numbers, then per
    conversation: a very long conversation meets in one task only as its result.
    """
    role, text = _escape_role(F.col("role")), escape(F.col("text"))
    turns = messages.select(
        "conv_id", "position", "role", "text", F.floor(F.col("position") / block).alias("block"),
        F.concat(F.lit(OPEN), role, F.lit(": "), text, F.lit(CLOSE)).alias("turn"),
        F.struct((F.length(role) + len(OPEN) + 2).alias("skip"),
                 F.when(F.col("role") == "assistant", F.length(text)).otherwise(0).alias("take")).alias("mask"))
    blocks = turns.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("position", "role", "text", "turn", "mask"))).alias("own"))
    blocks = blocks.select("conv_id", F.struct(
        "block", F.array_join(F.transform("own", lambda t: t["turn"]), "").alias("formatted"),
        F.transform("own", lambda t: t["mask"]).alias("mask")).alias("part"))
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select("conv_id", F.array_join(F.transform("parts", lambda p: p["formatted"]), "").alias("formatted"),
                        F.flatten(F.transform("parts", lambda p: p["mask"])).alias("loss_mask"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(`conv_id`, `turns`, `loss_text`, `formatted`): the turns (role, text) as the
    formatted string says them, and the unescaped text under the loss mask."""
    raw = F.split("formatted", F.lit(CLOSE), -1)
    rows = rendered.select("conv_id", "formatted", "loss_mask",
                           F.slice(raw, 1, F.size(raw) - 1).alias("raw"))

    def turn(t):
        role = F.regexp_extract(t, r"^### ([^:]*): ", 1)
        return F.struct(_unescape_role(role).alias("role"),
                        unescape(F.substr(t, F.length(role) + len(OPEN) + 3)).alias("text"))

    under = F.zip_with("raw", "loss_mask", lambda t, m: unescape(F.substr(t, m["skip"] + 1, m["take"])))
    return rows.select("conv_id", "formatted", F.transform("raw", turn).alias("turns"),
                       F.array_join(under, "").alias("loss_text"))


def _each_turn(conversations: DataFrame) -> DataFrame:
    """Whole turns with a `msg_id` of their own. Equal rows are turns of their own, numbered after they are
    counted (per task first), so that many equal rows are one row until then; a null differs from any value."""
    columns = ["conv_id", "turn", "role", "text"]
    counted = conversations.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return rows.withColumn("msg_id", F.xxhash64(*columns[1:], *[F.col(c).isNull() for c in columns[1:]], "copy"))


def _as_log(rows: DataFrame, events: list[tuple]) -> DataFrame:
    """Events per turn: (kind, text, or None); their seqs follow each other."""
    said = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(kind).alias("event"),
                              (F.lit(None).cast("string") if text is None else text).alias("text"))
                     for i, (kind, text) in enumerate(events)])
    log = rows.select("conv_id", "turn", "msg_id", "role", F.explode(said).alias("said"))
    seq = F.try_add(F.try_multiply(F.col("turn").cast("long"), F.lit(len(events))), F.col("said.i").cast("long"))
    return log.select("conv_id", seq.alias("seq"), "msg_id", "said.event", "role", F.col("said.text").alias("text"))


def turn_events(conversations: DataFrame) -> DataFrame:
    """A table of whole turns (`conv_id`, `turn`, `role`, `text`) as an event log: a start
    that names the role and a delta with the text."""
    return _as_log(_each_turn(conversations), [("start", F.lit("")), ("delta", F.col("text"))])


def streamed_events(conversations: DataFrame) -> DataFrame:
    """The same turns as a log with everything in it, which folds to the given texts: a start, a streamed
    draft that a regenerate throws away, a first half that an edit corrects, the second half in two deltas.
    A turn without a number has no order of events and comes as one start."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    piece = lambda a, b: F.substr(text, a + 1, b - a)
    half, late = F.floor(n / 2).cast("int"), F.floor(n * 3 / 4).cast("int")
    events = [("start", F.lit("")), ("delta", F.concat(F.lit("draft "), piece(F.lit(0), half))), ("regenerate", None),
              ("delta", F.lit("first try")), ("edit", piece(F.lit(0), half)), ("delta", piece(half, late)),
              ("delta", piece(late, n))]
    turns = _each_turn(conversations)
    loose = turns.where("turn is null").select("conv_id", F.lit(None).cast("long").alias("seq"), "msg_id",
                                               F.lit("start").alias("event"), "role", "text")
    return _as_log(turns.where("turn is not null"), events).unionByName(loose)


def format_conversations(conversations: DataFrame, as_log=turn_events) -> DataFrame:
    """`render` of a table of whole turns, by way of an event log. Null texts are empty turns, a null
    conv_id is a conversation of its own, equal rows are turns of their own, an empty table gives no
    rows; other columns are not read."""
    return render(fold_events(as_log(conversations)))
