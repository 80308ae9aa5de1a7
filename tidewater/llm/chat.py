"""Chat formatting with a grammar that reads back exactly what was written.

A turn is ``<s>[INST:role] text [/INST]</s>``; the parser parts a conversation at ``</s>``
and takes role and text from each part. Texts are first written as they are and read
back; one that does not come back identical is written again with backslashes before
backslashes and inside ``</s>``, then with one before every sign of the markers. The last
form always comes back. Roles write ``%``, ``]`` and ``<`` by their percent codes.

All of it is DataFrame functions: one shuffle gathers the turns of a conversation, whose
formatted text is one value by its nature.

Turns go by turn, then role, then text, nulls first; repeated rows are repeated turns. A
null role or text is empty, a null conv_id is a conversation of its own. An empty table
gives an empty result. Extra columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ASSISTANT = "assistant"
_TURN = r"(?s)^<s>\[INST:([^\]]*)\] (.*) \[/INST\]\z"
_END, _CLOSE = "</s>", " [/INST]"
_ROLE_CODES = (("%", "%25"), ("]", "%5D"), ("<", "%3C"))


def _write_role(role: Column) -> Column:
    for sign, code in _ROLE_CODES:
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def _read_role(role: Column) -> Column:
    for sign, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(sign))
    return role


def _header(role: Column) -> Column:
    return F.concat(F.lit("<s>[INST:"), _write_role(role), F.lit("] "))


def _render(role: Column, body: Column) -> Column:
    return F.concat(_header(role), body, F.lit(_CLOSE + _END))


def _unescape(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\\(.)", "$1")


def parse(formatted: Column) -> Column:
    """Turns ``array<struct<role, text>>`` of a formatted conversation."""
    parts = F.split(formatted, _END, -1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda part: F.struct(
            _read_role(F.regexp_extract(part, _TURN, 1)).alias("role"),
            _unescape(F.regexp_extract(part, _TURN, 2)).alias("text"),
        ),
    )


def _escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    if level == 1:
        return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(_END), F.lit("<\\/s>"))
    return F.regexp_replace(text, r"([\\<\[\]/>])", r"\\$1")


def render_turns(turns: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text, level, rendered)``: each at the least level that reads back."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    written = [_render(F.col("role"), _escape(F.col("text"), level)) for level in (0, 1, 2)]
    level = F.when(parse(written[0]) == source, 0).when(parse(written[1]) == source, 1).otherwise(2)
    chosen = F.when(F.col("level") == 0, written[0]).when(F.col("level") == 1, written[1]).otherwise(written[2])
    return rows.withColumn("level", level).withColumn("rendered", chosen)


def format_conversations(turns: DataFrame, spans: bool = True) -> DataFrame:
    """``(conv_id, n_turns, formatted, escaped_turns, identical[, loss_spans])``.

    ``identical``: the formatted text reads back as its source. ``loss_spans``: start and end
    (code points, end excluded) of every assistant body in the formatted text.
    """
    rows = render_turns(turns)
    fields = ["turn", "role", "text", "level", "rendered"]
    if spans:
        before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("begin", F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)))
        fields.append("begin")
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("turns"))
    formatted = gathered.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["rendered"]), ""))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    out = [
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        "formatted",
        F.size(F.filter("turns", lambda t: t["level"] > 0)).cast("bigint").alias("escaped_turns"),
        (parse(F.col("formatted")) == source).alias("identical"),
    ]
    if spans:
        own = F.filter("turns", lambda t: t["role"] == ASSISTANT)
        span = lambda t: F.struct(
            (t["begin"] + F.length(_header(t["role"]))).alias("start"),
            (t["begin"] + F.length(t["rendered"]) - len(_CLOSE + _END)).alias("end"),
        )
        out.append(F.transform(own, span).alias("loss_spans"))
    return formatted.select(*out)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back, as counts and digests; the loss text is what ``loss_spans`` cut out."""
    read = formatted.select("conv_id", "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    cut = lambda s: _unescape(F.substr("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))
    loss = F.array_join(F.transform("loss_spans", cut), "")
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), lines.alias("lines"), loss.alias("loss"), "formatted").select(
        "conv_id",
        "n_turns",
        F.sha2("lines", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
