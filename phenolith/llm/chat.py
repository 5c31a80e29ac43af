"""Chat formatting: render conversations, read them back, escape what a reader would take for marks.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. The reader is deterministic: it cuts at the marks, takes
the first line of a part as role and the rest as text. What it recovers is compared with the source; the conversations
that differ are escaped and rendered again. Everything is built-in column functions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolith.llm.running import running_sum

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = r"<(\\*)\|(im_start|im_end)\|>"
_ESCAPED = r"<\\(\\*)\|(im_start|im_end)\|>"


def escape(text: Column) -> Column:
    """Put one more backslash after the ``<`` of whatever looks like a mark, escaped or not; ``unescape`` takes it away."""
    return F.regexp_replace(text, _CONTROL, r"<\\$1|$2|>")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"<$1|$2|>")


def _role_out(role: Column) -> Column:
    """A role must stay on its line: its backslashes and line ends are escaped, and marks like those of a text."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_in(role: Column) -> Column:
    held = F.replace(role, F.lit("\\\\"), F.lit("\0\\\0"))  # a pair is one backslash, whatever follows
    return unescape(F.replace(F.replace(held, F.lit("\\n"), F.lit("\n")), F.lit("\0\\\0"), F.lit("\\")))


def render(turns: Column, escaped: bool) -> Column:
    """``turns``: array of structs role, text."""
    change = escape if escaped else (lambda c: c)
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), _role_out(t["role"]) if escaped else t["role"], F.lit("\n"), change(t["text"]), F.lit(END + "\n"))), "")


def parse(rendered: Column) -> Column:
    """The turns of a rendered conversation as structs of role, text and the place of the (escaped) text in it.

    A part that breaks the grammar (no line end after the role, no end mark as last characters, or an end mark inside)
    gets a null role, which equals no source.
    """
    parts = F.slice(F.split(rendered, r"<\|im_start\|>"), 2, 1 << 30)
    whole = lambda p: F.contains(p, F.lit("\n")) & p.endswith(END + "\n") & (F.position(F.lit(END), p) == F.length(p) - len(END))
    header = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substring(p, F.length(header(p)) + 2, F.length(p) - F.length(header(p)) - 2 - len(END))
    cut = F.transform(parts, lambda p: F.struct(
        F.when(whole(p), _role_in(header(p))).alias("role"), F.when(whole(p), body(p)).alias("raw"),
        F.length(p).alias("chars"), (F.length(header(p)) + 1).alias("lead")))

    def placed(held: Column) -> Column:
        ends = running_sum(F.transform(held, lambda t: len(START) + t["chars"]))

        def turns(stops: Column) -> Column:
            begin = lambda t, i: F.get(stops, i) - t["chars"] + t["lead"]
            return F.transform(held, lambda t, i: F.struct(
                t["role"].alias("role"), unescape(t["raw"]).alias("text"), begin(t, i).alias("start"), (begin(t, i) + F.length(t["raw"])).alias("stop")))

        return F.get(F.transform(F.array(ends), turns), F.lit(0))

    return F.get(F.transform(F.array(cut), placed), F.lit(0))


def _same(turns: Column, source: Column) -> Column:
    plain = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    return F.transform(turns, plain) == F.transform(source, plain)


def format_chats(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``key``, ``formatted``, ``escaped`` and ``turns`` as read back (role, text, start, stop).

    ``start`` and ``stop`` are code points in ``formatted``: the loss mask of a role is the spans of its turns. Rows of a
    conversation are put in order of turn, then role and text, so that ties and repeated rows have one result; null roles and
    texts are empty ones, null turns come first, and a null key is a conversation of its own. Other columns are left out;
    an empty table gives an empty one. A conversation is one text, so its turns meet in one task; they are all that does.
    """
    one = df.select(F.col(f"`{key}`").alias("_key"), F.struct(
        F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).alias("_turn"))
    source = one.groupBy("_key").agg(F.sort_array(F.collect_list("_turn")).alias("_source"))
    plain = source.withColumn("_plain", render(F.col("_source"), False))
    read = plain.withColumn("_read", parse(F.col("_plain")))
    judged = read.withColumn("_clash", ~F.coalesce(_same(F.col("_read"), F.col("_source")), F.lit(False)))
    again = judged.withColumn("_out", F.when(F.col("_clash"), render(F.col("_source"), True)).otherwise(F.col("_plain")))
    final = again.withColumn("_turns", F.when(F.col("_clash"), parse(F.col("_out"))).otherwise(F.col("_read")))
    # The second reading must be identical; escaping leaves no mark in a text, so this never fires.
    checked = F.when(_same(F.col("_turns"), F.col("_source")), F.col("_out")).otherwise(F.raise_error(F.lit("a conversation can't be read back")))
    return final.select(F.col("_key").alias(key), checked.alias("formatted"), F.col("_clash").alias("escaped"), F.col("_turns").alias("turns"))
