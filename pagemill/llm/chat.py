r"""Chat formatting with Spark expressions only.

A conversation becomes one string: adjacent turns of one role form a block ``<s>role<t>text<t>text</s>``, in which
each turn's text follows its own ``<t>``.  The control strings of this template and of common chat formats are
escaped inside roles and texts by one backslash after their first character (``</s>`` becomes ``<\/s>``, and
``<\/s>`` becomes ``<\\/s>``), which is undone by removing one.  So the turns can be read back exactly.

Defined cases: a null text or role is empty; turns sort by (turn, role, text as given), null turns first, and equal
rows stay as turns of their own; null is a conversation id like any other; an empty table gives no rows; columns other
than the four are left out, whatever their names.  A conversation of very many or very long turns is one string in one
task, as its format demands; it is cut up in two steps (GROUP spans at a time), so that no step reads all of it for
every turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Role whose texts carry loss.
LEARNED = "assistant"
_CONTROL = r"(/?s>|t>|\|[a-z_]+\|>|/?SYS>)"
_BRACKET = r"(/?INST\])"
OPEN, TEXT, CLOSE = "<s>", "<t>", "</s>"
#: Spans that are cut from the text between them, rather than each from the whole conversation.
GROUP = 256


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*)" + _CONTROL, r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*)" + _BRACKET, r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"\[\\(\\*)" + _BRACKET, r"[$1$2")
    return F.regexp_replace(text, r"<\\(\\*)" + _CONTROL, r"<$1$2")


def format_chats(turns: DataFrame) -> DataFrame:
    """``turns``: conv_id, turn, role, text.

    Returns conv_id, formatted and spans: for each turn in order whether its text carries loss, and where the text
    starts and ends (exclusive) in ``formatted``, in code points.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.length(escape(text)).alias("size"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.lag("role").over(order)
    opens = F.when(before.isNull(), len(OPEN)).when(before != F.col("role"), len(CLOSE) + len(OPEN))
    rows = rows.withColumn("chars", F.coalesce(opens + F.length(escape(F.col("role"))), F.lit(0)) + len(TEXT) + F.col("size"))
    rows = rows.withColumn("end", F.sum("chars").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "end", "size"))).alias("t"))
    size = F.size("t")
    starts = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get("t", i)["role"] != F.get("t", i - 1)["role"]))
    spans = F.transform("t", lambda x: F.struct((x["role"] == LEARNED).alias("learned"), (x["end"] - x["size"]).alias("start"), x["end"].alias("end")))
    merged = sorted_.select("conv_id", "t", starts.alias("starts"), spans.alias("spans"))
    until = lambda k: F.coalesce(F.get("starts", k + 1), size)
    texts = lambda i, k: F.array_join(F.transform(F.slice("t", i + 1, until(k) - i), lambda x: escape(x["text"])), TEXT)
    blocks = F.transform("starts", lambda i, k: F.concat(F.lit(OPEN), escape(F.get("t", i)["role"]), F.lit(TEXT), texts(i, k), F.lit(CLOSE)))
    return merged.select("conv_id", F.array_join(blocks, "").alias("formatted"), "spans")


def masked(formatted: str, spans: Column) -> Column:
    """The texts that ``spans`` (in order) cut out of the column ``formatted``, unescaped one by one."""
    size = F.size(spans)
    groups = F.when(size > 0, F.transform(F.sequence(F.lit(0), F.floor((size - 1) / GROUP).cast("int")), lambda g: F.slice(spans, g * GROUP + 1, GROUP)))
    low, high = lambda g: F.get(g, F.lit(0))["start"], lambda g: F.element_at(g, -1)["end"]
    cut = lambda text, start, end: F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))
    pieces = F.transform(groups, lambda g: F.struct(cut(F.col(formatted), low(g), high(g)).alias("text"), low(g).alias("low"), g.alias("spans")))
    texts = F.flatten(F.transform(pieces, lambda p: F.transform(p["spans"], lambda x: unescape(cut(p["text"], x["start"] - p["low"], x["end"] - p["low"])))))
    return F.coalesce(texts, F.array().cast("array<string>"))


def read_back(formatted: DataFrame) -> DataFrame:
    """From ``formatted`` and ``spans``: conv_id, formatted, turns (role, text; from the template's marks) and learned
    (the texts under the loss mask; from the positions in ``spans``)."""
    literal = lambda s: "\\Q" + s + "\\E"
    # No text contains a control string; what follows the last closing mark is empty.
    blocks = F.slice(F.split("formatted", literal(CLOSE), -1), 1, F.size(F.split("formatted", literal(CLOSE), -1)) - 1)
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, len(OPEN) + 1, 2147483647), literal(TEXT), -1))
    df = formatted.select("conv_id", "formatted", F.filter("spans", lambda s: s["learned"]).alias("spans"), parts.alias("parts"))
    turns = F.flatten(F.transform("parts", lambda b: F.transform(F.slice(b, 2, F.size(b)), lambda x: F.struct(unescape(F.get(b, F.lit(0))).alias("role"), unescape(x).alias("text")))))
    return df.select("conv_id", "formatted", turns.alias("turns"), masked("formatted", F.col("spans")).alias("learned"))


def chat_digest(turns: DataFrame) -> DataFrame:
    back = read_back(format_chats(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), F.array_join("learned", "").alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return back.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
