"""Chat formatting by grammar round trip, in DataFrame functions only.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. A deterministic parser splits the rendered text again; a
turn that does not come back identical is rendered with its conflicting content escaped (one backslash more between
``<`` and ``|``, undone by the parser), and the whole conversation is parsed again and compared with its source.

Defined results: a null text or role is empty; rows are ordered by turn (nulls first), then role, then text, so ties and
repeated rows all stay, in a fixed order; a null conv_id is a conversation of its own; an empty table gives no rows; extra
columns are ignored; texts and conversations of any length are taken whole, up to Spark's limit of 2 GB for one value, as a
conversation becomes one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>: a turn runs from a start mark to its first end mark, its role to the first line break."""

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        rest = F.substring(part, F.length(head) + 2, F.length(part))
        role = unescape(F.replace(head, F.lit(LINE), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substring_index(rest, END, 1)).alias("text"))

    parts = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def format_conversations(conversations: DataFrame, trained_role: str = "assistant", keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """keys, formatted, turns (as parsed back), loss_spans (of `formatted` under the loss mask: code points, and bytes).

    Fails if a conversation does not come back identical after escaping.
    """
    rows = conversations.select(*keys, "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    source = F.array(F.struct("role", "text"))
    plain = parse(render(F.col("role"), F.col("text"))) == source
    safe_role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit(LINE))
    rows = rows.withColumn("plain", plain)
    rows = rows.withColumns({"r": F.when(F.col("plain"), F.col("role")).otherwise(safe_role), "t": F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text")))})
    order = Window.partitionBy(*keys).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("rendered", render(F.col("r"), F.col("t")))
    rows = rows.withColumns({"upto": F.sum(F.length("rendered")).over(order), "bytes": F.sum(F.octet_length("rendered")).over(order)})
    end, end_byte = F.col("upto") - len(END) - 1, F.col("bytes") - len(END) - 1
    span = F.struct((end - F.length("t")).alias("start"), end.alias("end"), (end_byte - F.octet_length("t")).alias("start_byte"), end_byte.alias("end_byte"))
    grouped = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered", F.when(F.col("role") == trained_role, span).alias("span")))).alias("x")
    )
    whole = grouped.select(
        *keys,
        F.array_join(F.transform("x", lambda t: t.rendered), "").alias("formatted"),
        F.transform("x", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("source"),
        F.filter(F.transform("x", lambda t: t.span), lambda s: s.isNotNull()).alias("loss_spans"),
    ).withColumn("back", parse(F.col("formatted")))
    return whole.select(
        *keys,
        "formatted",
        F.when(F.col("back") == F.col("source"), F.col("back")).otherwise(F.raise_error(F.lit("a conversation did not survive its round trip"))).alias("turns"),
        "loss_spans",
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Figures read back from the output: of the parsed turns, and of what stands in the rendered text under the loss mask."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    out = formatted.withColumn("raw", F.encode("formatted", "UTF-8"))  # a slice of bytes costs its own length, not the text's
    masked = lambda s: F.substring(F.col("raw"), (s.start_byte + 1).cast("int"), (s.end_byte - s.start_byte).cast("int"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.decode(masked(s), "UTF-8"))), "")
    out = out.withColumns({"loss": loss, "formatted_bytes": F.octet_length("raw").cast("long")})
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "formatted_bytes",
    )
