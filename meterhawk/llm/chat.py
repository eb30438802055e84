"""Chat formatting by grammar round trip.

A formatted conversation is a run of turns, each written ``### Role: body</turn>`` and a line feed. The
parser is deterministic: ``### `` opens a turn, the first ``: `` ends its role, and the turn must hold
exactly one ``</turn>``, at its end; then ``\\x`` is read as ``x`` in roles and bodies. Text is first written
as it is. The result is parsed and compared with the source; turns that do not come back as they were are
escaped, and the comparison is repeated until both are identical. A conversation that would still differ
stops the job.

Escaping doubles a backslash and puts one into each control string, so that no control string is left:
``### `` becomes ``#\\## ``, ``</turn>`` becomes ``<\\/turn>``, and in roles ``: `` becomes ``:\\ ``.

Everything is DataFrame functions. Defined cases: a null text or role is the empty string; turns of one
conversation are ordered by turn, then role, then text, a null turn first; rows of a null conv_id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template.
OPEN = "### "
ROLE_END = ": "
CLOSE = "</turn>"
TURN_END = CLOSE + "\n"
TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    closed = F.replace(doubled, F.lit(CLOSE), F.lit("<\\/turn>"))
    return F.replace(closed, F.lit(OPEN), F.lit("#\\## "))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(ROLE_END), F.lit(":\\ "))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _titled(role: Column) -> Column:
    title = role
    for name, shown in TITLES.items():
        title = F.when(role == name, F.lit(shown)).otherwise(title)
    return title


def _role_of(title: Column) -> Column:
    role = unescape(title)
    for name, shown in TITLES.items():
        role = F.when(title == shown, F.lit(name)).otherwise(role)
    return role


def _written(turn: Column, escaped: Column) -> Column:
    """A turn's header and body, plain or escaped. An escaped role that is a title's own word starts with a backslash."""
    role, text = turn["role"], turn["text"]
    known = role.isin(*TITLES)
    safe_role = F.when(role.isin(*TITLES.values()), F.concat(F.lit("\\"), role)).otherwise(escape_role(role))
    head = F.when(known, _titled(role)).when(escaped, safe_role).otherwise(role)
    return F.struct(
        F.concat(F.lit(OPEN), head, F.lit(ROLE_END)).alias("head"),
        F.when(escaped, escape(text)).otherwise(text).alias("body"),
        role.alias("role"),
    )


def _rendered(written: Column) -> Column:
    return F.array_join(F.transform(written, lambda w: F.concat(w["head"], w["body"], F.lit(TURN_END))), "")


def parse(formatted: Column) -> Column:
    """Turns of a formatted text as array<struct<role, text>>; null where it breaks the grammar."""
    pieces = F.split(formatted, OPEN)
    turns = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def read(piece: Column) -> Column:
        colon = F.instr(piece, ROLE_END)
        ends = F.instr(piece, CLOSE)
        whole = (colon > 0) & (ends > colon) & (ends == F.length(piece) - len(TURN_END) + 1) & piece.endswith(TURN_END)
        turn = F.struct(
            _role_of(F.substring(piece, F.lit(1), colon - 1)).alias("role"),
            unescape(F.substring(piece, colon + len(ROLE_END), ends - colon - len(ROLE_END))).alias("text"),
        )
        return F.when(whole, turn)

    read_all = F.transform(turns, read)
    return F.when((F.element_at(pieces, 1) == "") & ~F.exists(read_all, lambda t: t.isNull()), read_all)


def _returns(written: Column, turns: Column) -> Column:
    return F.coalesce(parse(_rendered(written)) == turns, F.lit(False))


def _mask(written: Column, role: str) -> Column:
    """[start, length) of each body of ``role`` in the rendered text, in code points, starts from 0."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(state: Column, w: Column) -> Column:
        start = state["at"] + F.length(w["head"])
        span = F.struct(start.cast("long").alias("start"), F.length(w["body"]).cast("long").alias("length"))
        spans = F.when(w["role"] == role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        after = (start + F.length(w["body"]) + len(TURN_END)).cast("long")
        return F.struct(after.alias("at"), spans.alias("spans"))

    return F.aggregate(written, zero, step, lambda state: state["spans"])


def format_conversations(rows: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask, and the turns read back from ``formatted``."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ordered"))
    source = gathered.select(
        "conv_id",
        F.transform("ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    plain = F.transform("source", lambda t: _written(t, F.lit(False)))
    alone = F.transform("source", lambda t: _written(t, ~_returns(F.array(_written(t, F.lit(False))), F.array(t))))
    every = F.transform("source", lambda t: _written(t, F.lit(True)))
    first = source.withColumn("written", plain).withColumn("same", _returns(F.col("written"), F.col("source")))
    for attempt in (alone, every):
        first = first.withColumn("written", F.when(F.col("same"), F.col("written")).otherwise(attempt)).withColumn(
            "same", F.col("same") | _returns(F.col("written"), F.col("source"))
        )
    done = first.withColumn("formatted", _rendered(F.col("written"))).withColumn(
        "turns", F.when(F.col("same"), parse(F.col("formatted"))).otherwise(F.raise_error(F.lit("a conversation does not come back")))
    )
    return done.select("conv_id", "formatted", _mask(F.col("written"), loss_role).alias("loss_mask"), "turns")


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    taken = F.transform(
        loss_mask,
        lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return F.array_join(taken, "")


def digest(formatted: DataFrame) -> DataFrame:
    """The figures of each formatted conversation, all taken from the formatted text."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = formatted.withColumn("loss", loss_text(F.col("formatted"), F.col("loss_mask")))
    return loss.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
