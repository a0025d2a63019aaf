"""Chat formatting into budgeted windows, in DataFrame operations only.

A turn is ``<|turn|>role<|text|>text<|end|>``. In roles and texts a backslash is doubled and
every control string, the template's own and those of other chat formats, gets a backslash
after its first character; taking each backslash out, and keeping what follows it, restores
the text. So no control string of a text survives, and ``<|`` occurs in the output only where
the template put it.

Windows are turn-aligned. Prefix sums of the turns' tokens (words and ``TURN_TOKENS`` for the
marks) lay the turns along a line; a window has the turns that begin within one stride, which is
the budget less the history and the conversation's own system turn, so a window exceeds its
budget by less than its last turn. The system turn, if the conversation begins with one, is
repeated at the head of each window.
Turns of the window before that begin within its last ``history`` tokens are repeated as
context. The loss covers the texts of assistant turns, each in its own window only: targets
that are repeated as history are masked.

Defined results:

* Turns are ordered by turn, role and text, nulls first. Rows that repeat a turn are turns of
  their own. A null text or role is the empty string. A null conv_id is a conversation.
* A system turn that isn't first is an ordinary turn. So is one of more than ``system`` tokens,
  which would leave a window no room: it is in the first window, like any long turn.
* Texts of any length are taken whole.
* An empty table gives an empty result. Extra columns are ignored.

A conversation is read from its turns by windows that stream; one row has one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

#: Control strings of this template (all begin with "<|") and of other common ones.
CONTROL = r"<(?=\||/?s>|</?SYS>>|(?:bos|eos|pad|unk|start_of_turn|end_of_turn)>)|\[(?=/?INST\])"

BUDGET = 512
HISTORY = 128
#: The most tokens of a system turn that is repeated.
SYSTEM = 256
TURN_TOKENS = 4
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def words(text: Column) -> Column:
    """The number of words: blanks end at a word, and none begins within one."""
    trimmed = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    return F.when(trimmed == "", 0).otherwise(
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])"))
    )


def chat_windows(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    system: int = SYSTEM,
) -> DataFrame:
    """conv_id, window, repeated, formatted, spans, tokens: a row for each window.

    ``repeated`` is the number of turns at its head that an earlier window has. ``spans`` are the parts of ``formatted`` under the loss: arrays of start (from 0) and
    length, in code points.
    """
    if budget - history - system < max(history, 1):
        raise ValueError("the budget is too small for that history and system turn")
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    conversation = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumns(
        {"nth": F.row_number().over(conversation), "tokens": words(F.col("text")) + TURN_TOKENS}
    )
    rows = rows.withColumn(
        "head", (F.col("nth") == 1) & (F.col("role") == "system") & (F.col("tokens") <= system)
    )
    first_tokens = F.first(F.when(F.col("head"), F.col("tokens"))).over(conversation)
    # where each turn begins on the line; the system turn has no place on it
    own = F.when(F.col("head"), 0).otherwise(F.col("tokens"))
    rows = rows.withColumns(
        {
            "begins": F.sum(own).over(conversation) - own,
            "head_tokens": F.coalesce(first_tokens, F.lit(0)),
        }
    )
    stride = F.lit(budget - history) - F.col("head_tokens")
    window = F.floor(F.col("begins") / stride)
    late = (F.col("begins") % stride >= stride - history) & ~F.col("head")
    repeats = F.when(late, F.array(window, window + 1)).otherwise(F.array(window))
    piece = F.concat(
        F.lit(TURN), escape(F.col("role")), F.lit(TEXT), escape(F.col("text")), F.lit(END)
    )
    first_piece = F.first(F.when(F.col("head"), piece)).over(conversation)
    rows = rows.select(
        "conv_id",
        F.coalesce(first_piece, F.lit("")).alias("head_piece"),
        "head_tokens",
        F.explode(repeats).alias("window"),
        F.struct(
            "nth",
            piece.alias("piece"),
            (F.col("role") == TARGET).alias("target"),
            F.length(escape(F.col("text"))).alias("chars"),
            window.alias("own_window"),
            "tokens",
            "head",
        ).alias("turn"),
    )
    # Rows of a conversation are together since the first window; this moves none of them.
    joined = (
        rows.groupBy("conv_id", "window")
        .agg(
            F.sort_array(F.collect_list("turn")).alias("all"),
            F.any_value("head_piece").alias("head_piece"),
            F.any_value("head_tokens").alias("head_tokens"),
        )
        # history alone is no window
        .where(F.exists("all", lambda t: t["own_window"] == F.col("window")))
        .withColumn("turns", F.filter("all", lambda t: ~t["head"]))
    )
    formatted = F.concat("head_piece", F.array_join(F.transform("turns", lambda t: t["piece"]), ""))
    # the end of each turn in the output, from the lengths of the turns so far
    none = F.struct(
        F.length("head_piece").cast("long").alias("at"),
        F.array().cast("array<struct<start:long,length:long>>").alias("spans"),
    )
    end = len(END)

    def add(state: Column, t: Column) -> Column:
        after = state["at"] + F.length(t["piece"])
        span = F.struct(
            (after - end - t["chars"]).alias("start"), t["chars"].cast("long").alias("length")
        )
        target = t["target"] & (t["own_window"] == F.col("window"))
        more = F.when(target, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(after.alias("at"), more.alias("spans"))

    before = F.size(F.filter("turns", lambda t: t["own_window"] < F.col("window")))
    with_head = F.when((F.col("window") > 0) & (F.col("head_piece") != ""), 1).otherwise(0)
    return joined.select(
        "conv_id",
        F.col("window").cast("long").alias("window"),
        (before + with_head).alias("repeated"),
        formatted.alias("formatted"),
        F.aggregate("turns", none, add, lambda s: s["spans"]).alias("spans"),
        (
            F.col("head_tokens")
            + F.aggregate("turns", F.lit(0), lambda s, t: s + t["tokens"])
        ).alias("tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the output.

    Each turn is read where it isn't repeated.
    """
    piece = r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>"
    parts = windows.select(
        "conv_id",
        "window",
        "formatted",
        "spans",
        F.transform(
            F.arrays_zip(
                F.regexp_extract_all("formatted", F.lit(piece), 1).alias("role"),
                F.regexp_extract_all("formatted", F.lit(piece), 2).alias("text"),
            ),
            lambda t: F.concat(unescape(t["role"]), F.lit("\n"), unescape(t["text"]), F.lit("\n")),
        ).alias("turns"),
        "repeated",
    )
    loss = F.array_join(
        F.transform(
            "spans",
            lambda s: unescape(
                F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
    fresh = F.slice("turns", F.col("repeated") + 1, F.greatest(F.size("turns"), F.lit(1)))
    each = parts.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(fresh, "").alias("turns"),
            loss.alias("loss"),
        ).alias("part"),
        F.size(fresh).alias("n"),
        F.length("formatted").alias("chars"),
    )
    whole = each.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = F.array_join(F.col("parts.turns"), "")
    lost = F.array_join(F.col("parts.loss"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        "formatted_chars",
    )
