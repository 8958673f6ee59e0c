"""Chat formatting of typed content parts, with DataFrame functions only.

A message holds ordered parts of type text, image, audio or document.  The
visitor flattens them in order: text is escaped, every other part becomes a
placeholder ``<|type:k|>`` repeated for its expanded token count, k counting
the conversation's attachments, whose references are recorded.  A turn is
``<|start|>role<|sep|>content<|end|>`` and a line feed.

Escaping is reversible: ``<`` in a role or text becomes ``<\\``, and no
control string of the template has a backslash after its ``<``, so none can
be forged and undoing ``<\\`` gives the text back exactly.  The loss mask covers
the content of assistant turns.

NULL text is empty, NULL role is the role ``""``; NULL parts are no parts, an
unknown part type is a placeholder of that (escaped) type; a NULL token count
is one.  Rows are ordered by turn, ties by role and content, NULL turns first;
conversations with NULL id form one conversation.  An empty table gives no
rows.  A conversation is one row of the result, as its template is one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"
START, SEP, END = "<|start|>", "<|sep|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def text_parts(text: Column) -> Column:
    """A plain text as content parts."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).alias("tokens")))


def format_chats(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans: array<struct<start, length>>,
    attachments: array<struct<k, type, ref, tokens>>, attachment_tokens) from
    rows (conv_id, turn, role, parts: array<struct<type, text, ref, tokens>>).

    A turn is visited in its own row, knowing only how many attachments and
    code points come before it; then the conversation is gathered.  Spans count
    code points of ``formatted`` from 0."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", F.array().cast(PARTS)).alias("parts"))
             .withColumn("others", F.expr("filter(parts, p -> NOT p.type <=> 'text')"))
             .withColumn("first", F.coalesce(F.sum(F.size("others").cast("bigint")).over(before), F.lit(0)))
             .withColumn("at", F.row_number().over(order)))
    visited = F.expr(r"""
        array_join(transform(parts, (p, j) ->
            CASE WHEN p.type <=> 'text' THEN replace(coalesce(p.text, ''), '<', '<\\')
                 ELSE repeat(concat('<|', replace(coalesce(p.type, ''), '<', '<\\'), ':',
                                    first + size(filter(slice(parts, 1, j), q -> NOT q.type <=> 'text')), '|>'),
                             coalesce(p.tokens, 1)) END), '')""")
    noted = F.expr("transform(others, (p, j) -> struct(first + j AS k, p.type AS type, p.ref AS ref, coalesce(p.tokens, 1) AS tokens))")
    turns = turns.select("conv_id", "at", "role", visited.alias("content"), noted.alias("noted"))
    said = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP), F.col("content"), F.lit(END))
    place = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumn("said", said).withColumn("ends", F.sum(F.length("said").cast("bigint")).over(place) - len(END))
    span = F.when(F.col("role") == "assistant", F.struct((F.col("ends") - F.length("content")).alias("start"), F.length("content").cast("bigint").alias("length")))
    return (turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "said", span.alias("span"), "noted"))).alias("m"))
            .select("conv_id", F.array_join(F.col("m.said"), "").alias("formatted"), F.filter(F.col("m.span"), lambda x: x.isNotNull()).alias("loss_spans"),
                    F.flatten(F.col("m.noted")).alias("attachments"))
            .withColumn("attachment_tokens", F.expr("aggregate(attachments, 0L, (n, p) -> n + p.tokens)")))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The input and ``turns``: array<struct<role, text>>, read back from the string."""
    pieces = F.expr(r"filter(split(formatted, '<\\|start\\|>', -1), x -> x <> '')")
    turns = F.expr(r"""transform(pieces, x -> struct(
        replace(substring_index(x, '<|sep|>', 1), '<\\', '<') AS role,
        replace(substring(x, instr(x, '<|sep|>') + 7, length(x) - instr(x, '<|sep|>') - 14), '<\\', '<') AS text))""")
    return formatted.withColumn("pieces", pieces).withColumn("turns", turns).drop("pieces")


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, span after span."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
