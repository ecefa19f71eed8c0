"""Chat formatting with typed content parts.

A message is a role and a list of parts: text, image, audio or document. A visitor turns each part into
text of the prompt: text is escaped, any other part becomes a placeholder at its place, and its reference
and the number of tokens it will expand to are recorded in order. The template is

    <|turn|>role<|says|>content<|end|>

Every control string begins with ``<|``. In roles and texts a backslash is put between ``<`` and ``|``
(and one more where there are some already), so no text can hold or forge a control string, and
taking one backslash away restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the template
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PART_TYPE = (
    "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
# Expansion of attachments: square image patches, audio frames a second, tokens of a document page.
PATCH, FRAMES, PAGE_TOKENS = 14, 25, 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


class PartVisitor:
    """One method for each kind of part, giving ``(content, ref, tokens)`` columns.

    Missing sizes count as nothing; a part of unknown or null kind is an attachment that expands to
    nothing and keeps its place. Subclass it for another model's rules.
    """

    kinds = ("text", "image", "audio", "document")

    def text(self, part: Column) -> tuple[Column, Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(None).cast("string"), F.lit(0).cast("long")

    def image(self, part: Column) -> tuple[Column, Column, Column]:
        patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
        return self.attachment("image", part, patches)

    def audio(self, part: Column) -> tuple[Column, Column, Column]:
        return self.attachment("audio", part, F.ceil(part["seconds"] * FRAMES))

    def document(self, part: Column) -> tuple[Column, Column, Column]:
        return self.attachment("document", part, part["pages"] * PAGE_TOKENS)

    def other(self, part: Column) -> tuple[Column, Column, Column]:
        return self.attachment("attachment", part, F.lit(0))

    def attachment(self, name: str, part: Column, tokens: Column) -> tuple[Column, Column, Column]:
        size = F.greatest(F.coalesce(tokens, F.lit(0)).cast("long"), F.lit(0).cast("long"))
        return F.lit(f"<|{name}|>"), part["ref"], size

    def visit(self, part: Column) -> Column:
        """struct<kind, content, ref, tokens> of a part."""
        fields = [getattr(self, kind)(part) for kind in self.kinds]
        other = self.other(part)

        def choose(i: int) -> Column:
            chosen = F.when(part["kind"] == self.kinds[0], fields[0][i])
            for kind, field in zip(self.kinds[1:], fields[1:], strict=True):
                chosen = chosen.when(part["kind"] == kind, field[i])
            return chosen.otherwise(other[i])

        return F.struct(
            part["kind"].alias("kind"), choose(0).alias("content"), choose(1).alias("ref"), choose(2).alias("tokens")
        )


def text_part(text: Column) -> Column:
    """A part list of one text."""
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


def format_chat(messages: DataFrame, visitor: PartVisitor | None = None, loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation of ``messages`` (conv_id, turn, role, parts: array of PART_TYPE):
    conv_id, formatted, loss_spans (begin and end code points of each text under the loss mask),
    attachments (kind, ref, tokens, in order of their placeholders) and attachment_tokens.

    Turns stand in order of turn, nulls first; equal turns by role, then content, so a repeated row is
    a repeated turn. A null conv_id is a conversation of its own. A null role is empty. Null parts are
    none; a null part is an attachment of no kind. Only texts of ``loss_role`` are under the mask. The
    offset of a turn is a running sum over its conversation; both it and the assembly need one shuffle.
    """
    visitor = visitor or PartVisitor()
    parts = F.transform(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART_TYPE}>")), visitor.visit)
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = messages.select("conv_id", "turn", role.alias("role"), parts.alias("parts"))
    turns = turns.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)))
    turns = turns.withColumn("content", F.array_join(F.col("parts.content"), ""))
    turns = turns.withColumn("size", F.length("head") + F.length("content") + len(END))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("content")]
    conversation = W.partitionBy("conv_id").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    turns = turns.withColumn("begin", F.sum("size").over(conversation) - F.col("size") + F.length("head"))
    turns = turns.withColumn("nth", F.count("*").over(conversation))
    # begin and end of each part inside its turn
    ends = F.transform(
        F.sequence(F.lit(1), F.size("parts")),
        lambda i: F.aggregate(F.slice("parts", 1, i), F.lit(0), lambda n, p: n + F.length(p["content"])),
    )
    ends = F.when(F.size("parts") == 0, F.array().cast("array<int>")).otherwise(ends)
    spans = F.zip_with(
        "parts", ends,
        lambda p, end: F.struct(
            p["kind"].alias("kind"),
            (F.col("begin") + end - F.length(p["content"])).alias("begin"),
            (F.col("begin") + end).alias("end"),
        ),
    )
    under = F.filter(spans, lambda s: s["kind"].eqNullSafe("text"))
    under = F.transform(under, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end")))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    attached = F.filter("parts", lambda p: ~p["kind"].eqNullSafe("text"))
    attached = F.transform(
        attached, lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))
    )
    piece = F.struct(
        "nth",
        F.concat("head", "content", F.lit(END)).alias("text"),
        F.when(F.col("role") == loss_role, under).otherwise(none).alias("spans"),
        attached.alias("attached"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.col("turns.text"), "").alias("formatted"),
        F.flatten(F.col("turns.spans")).alias("loss_spans"),
        F.flatten(F.col("turns.attached")).alias("attachments"),
    ).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    )


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, content>> read back from a formatted conversation; content still holds its
    placeholders and is escaped."""
    quoted = {s: s.replace("|", r"\|") for s in (TURN, SAYS, END)}
    turns = F.filter(F.split(formatted, quoted[END]), lambda t: t != "")
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring_index(F.substring(t, len(TURN) + 1, 1 << 30), SAYS, 1)).alias("role"),
            F.split(t, quoted[SAYS], 2)[1].alias("content"),
        ),
    )


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    mark = F.unhex(F.lit("0000FEFF"))  # decoding takes one byte-order mark away

    def cut(points: Column) -> Column:
        # four bytes for each code point, so that a slice costs what it holds
        def one(s: Column) -> Column:
            begin, size = (s["begin"] * 4 + 1).cast("int"), ((s["end"] - s["begin"]) * 4).cast("int")
            return unescape(F.decode(F.concat(mark, F.substring(points, begin, size)), "UTF-32"))

        return F.transform(spans, one)

    return F.transform(F.array(F.encode(formatted, "UTF-32")), cut)[0]
