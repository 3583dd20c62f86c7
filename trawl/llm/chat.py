"""Chat formatting with a grammar round trip, as DataFrame expressions.

A turn is written ``<|im_start|>role`` newline text ``<|im_end|>`` newline. Each rendered
turn is parsed again; where the parsed turn is not the source turn (its text holds a
control string), the turn is written in escaped form, opened by ``<|im_start_esc|>``, and
parsed again. Whole conversations are parsed once more and a difference raises an error.

Escapes (reversible): ``%`` is ``%25``, ``<|`` is ``%3C|``, a line break in a role is ``%0A``.

Defined cases: a null role or text is empty; a null turn number comes first; turns with
equal numbers are ordered by role and text; repeated rows are repeated turns; rows with a
null conversation id are one conversation; an empty table gives no rows; other columns are
ignored. A conversation becomes one string, so all its turns meet in one row by nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import only_null_free

START, START_ESCAPED, END = "<|im_start|>", "<|im_start_esc|>", "<|im_end|>"
CONTROL = "<|im_start"


def escape(value: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(value, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))
    return F.replace(out, F.lit("\n"), F.lit("%0A")) if role else out


def unescape(value: Column) -> Column:
    out = F.replace(F.replace(value, F.lit("%0A"), F.lit("\n")), F.lit("%3C"), F.lit("<"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def render(role: Column, text: Column, escaped: bool) -> Column:
    if escaped:
        role, text = escape(role, role=True), escape(text)
    return F.concat(F.lit(START_ESCAPED if escaped else START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation, or null where it breaks the grammar.

    Every end mark ends a turn wherever it stands; a start mark may only open one.
    """
    pieces = F.split(formatted, r"<\|im_end\|>", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)
    lines = F.transform(bodies, lambda p, i: F.when(i == 0, p).when(F.startswith(p, F.lit("\n")), F.substring(p, 2, 2**31 - 1)))

    def turn(line: Column) -> Column:
        escaped = F.startswith(line, F.lit(START_ESCAPED))
        opened = escaped | F.startswith(line, F.lit(START))
        body = F.when(escaped, F.substring(line, len(START_ESCAPED) + 1, 2**31 - 1)).otherwise(F.substring(line, len(START) + 1, 2**31 - 1))
        at = F.instr(body, "\n")
        role, text = F.substring_index(body, "\n", 1), body.substr(at + 1, F.length(body))
        sound = opened & (at > 0) & ~F.contains(body, F.lit(CONTROL))
        return F.when(sound, F.struct(
            F.when(escaped, unescape(role)).otherwise(role).alias("role"),
            F.when(escaped, unescape(text)).otherwise(text).alias("text"),
        ))

    turns = F.transform(lines, turn)
    whole = (F.element_at(pieces, -1) == F.when(F.size(pieces) == 1, "").otherwise("\n"))
    return F.when(whole & ~F.exists(turns, lambda t: t.isNull()), turns)


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_spans``.

    A loss span is (start, end, escaped): code-point offsets, from 0 and end exclusive, of
    the text of one turn whose role is ``learn``.
    """
    turns = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        only_null_free(F.col(role_col)).alias("role"), only_null_free(F.col(text_col)).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    tried = turns.withColumn("plain", render(F.col("role"), F.col("text"), False))
    tried = tried.withColumn("escaped", ~F.coalesce(parse(F.col("plain")) == source, F.lit(False)))
    written = tried.withColumn("line", F.when(F.col("escaped"), render(F.col("role"), F.col("text"), True)).otherwise(F.col("plain")))
    before = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    numbered = written.withColumn("offset", F.coalesce(F.sum(F.length("line").cast("long")).over(before), F.lit(0).cast("long")))
    head = F.when(F.col("escaped"), F.length(escape(F.col("role"), role=True)) + len(START_ESCAPED)).otherwise(F.length("role") + len(START)) + 1
    span = F.struct(
        (F.col("offset") + head).alias("start"),
        (F.col("offset") + F.length("line") - len(END) - 1).alias("end"),
        F.col("escaped"),
    )
    # offset alone is a total order: every rendered turn has a length.
    gathered = numbered.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
        "offset", "line", F.struct("role", "text").alias("source"), F.when(F.col("role") == learn, span).alias("span"),
    ))).alias("turns"))
    whole = gathered.select(
        "conv",
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"),
        F.array_compact(F.transform("turns", lambda t: t["span"])).alias("loss_spans"),
        F.transform("turns", lambda t: t["source"]).alias("source"),
    )
    same = F.coalesce(parse(F.col("formatted")) == F.col("source"), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))
    return whole.select(F.col("conv").alias(conv_col), checked.alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` parsed from the text and ``loss_text`` cut out by the loss spans."""
    cut = F.transform("loss_spans", lambda s: F.struct(
        F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).alias("text"), s["escaped"].alias("escaped"),
    ))
    text = F.array_join(F.transform(cut, lambda s: F.when(s["escaped"], unescape(s["text"])).otherwise(s["text"])), "")
    return formatted.withColumn("turns", parse(F.col("formatted"))).withColumn("loss_text", text)
