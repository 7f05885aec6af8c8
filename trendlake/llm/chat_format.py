"""Chat formatting: every assistant turn as an example of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm._frames import pick

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """``text`` without control strings: a backslash goes before the bar of every ``<|``.

    Where backslashes stand between the two already, there is one more; so ``unescape`` gives
    the text back, and no escaped text holds ``<|``, which every mark begins with.
    """
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role also ends at a line feed, so that and the percent sign are written as hex."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def head(role: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"))


def format_turn(role: Column, text: Column) -> Column:
    """One turn in the template: start mark, role, line feed, text, end mark, line feed."""
    return F.concat(head(role), escape(text), F.lit(END + "\n"))


def prefix_examples(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", reply: str = "assistant") -> DataFrame:
    """One example for every turn of role ``reply``, with all turns before it as context.

    Returns (conv_id, example, n_turns, formatted, loss_start, loss_end): ``formatted`` is the
    templated conversation up to and with the reply; only the characters from ``loss_start`` to
    before ``loss_end`` (from 0, code points), the reply's text, are trainable. Turns after the last
    reply, and conversations without one, come in a closing example with an empty span, so no turn
    is lost. ``example`` counts from 1 in a conversation.

    Turns are ordered by turn (null first), then role and text; rows alike stay turns of their
    own. Null roles and texts count as empty; null conversation ids are one conversation. An
    empty table gives an empty table; other columns are left out.

    An example is one text with its whole prefix, so one conversation has to fit in a row, and
    only one does: the turns are gathered once and examples leave one at a time.
    """
    given = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    shown = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = given.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), shown.alias("t")))).alias("all"))
    parts = gathered.select(
        "conv_id",
        F.transform("all", lambda x: format_turn(x.t.role, x.t.text)).alias("parts"),
        F.transform("all", lambda x: F.when(x.t.role == reply, F.length(escape(x.t.text)))).alias("lengths"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.size("parts")),
        lambda i: F.element_at("lengths", i).isNotNull() | (i == F.size("parts")),
    )
    cut = parts.select("*", F.posexplode(ends).alias("at", "end"))
    whole = cut.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        F.col("end").alias("n_turns"),
        F.array_join(F.slice("parts", 1, "end"), "").alias("formatted"),
        F.element_at("lengths", F.col("end")).alias("reply_length"),
    )
    stop = F.length("formatted") - len(END) - 1
    return whole.select(
        "conv_id",
        "example",
        "n_turns",
        "formatted",
        (stop - F.coalesce("reply_length", F.lit(0))).alias("loss_start"),
        stop.alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of a formatted text, as they were before escaping."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")
    body = lambda p: F.substr(p, F.lit(len(START) + 1))
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(body(p), "\n", 1)).alias("role"),
            unescape(F.substr(body(p), F.instr(body(p), "\n") + 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss_start: Column, loss_end: Column) -> Column:
    """The trainable text of an example, as it was before escaping."""
    return unescape(F.substr(formatted, loss_start + 1, loss_end - loss_start))
