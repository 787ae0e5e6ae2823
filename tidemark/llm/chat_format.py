"""Chat formatting with typed content parts.

A visitor flattens the parts of a turn (text, image, audio, document) in order: texts are escaped, other parts become
numbered placeholders, and for each the reference and the number of tokens it expands to are recorded. A turn becomes
``[TURN role]content</s>``. Inside roles and texts a backslash stands before ``[``, ``]``, ``<`` and the backslash itself, so no
text can hold a control string, and removing the backslashes gives the text back.

One row is written for each turn; a conversation is its rows in order, so no conversation has to fit into one row or task.
:func:`read_back` reads a conversation's rows as a stream in order and keeps nothing but running digests.

Cases: null text, role or parts are empty; a conversation with a null id is a conversation like any other; turns with equal
numbers follow in the order of role and content; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Tokens: one for each image patch of 28 x 28 pixels, 25 for a second of sound, 512 for a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 512
TURN = re.compile(r"\[TURN ((?:\\.|[^\]\\])*)\]((?:\\.|[^\\<]|<(?!/s>))*)</s>", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\\[\]<])", r"\\$1")


def _visit(part: Column, number: Column) -> Column:
    """The text that a part becomes; ``number`` is its place in the turn."""
    other = F.concat(F.lit("<"), escape(part["type"]), F.lit(" "), number.cast("string"), F.lit(">"))
    return F.when(F.coalesce(part["type"], F.lit("text")) == "text", escape(part["text"])).otherwise(other)


def _attachment(part: Column, number: Column) -> Column:
    tokens = (
        F.when(part["type"] == "image", F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH))
        .when(part["type"] == "audio", F.ceil(part["seconds"] * PER_SECOND))
        .when(part["type"] == "document", part["pages"] * PER_PAGE)
    )
    is_text = F.coalesce(part["type"], F.lit("text")) == "text"
    return F.struct(number.alias("number"), F.when(~is_text, part["type"]).alias("type"), part["ref"].alias("ref"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    one = F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), null("string").alias("ref"), null("int").alias("width"), null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"))
    return F.array(one).cast(PARTS)


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """From a row for each turn with typed parts: conv_id, turn, segment (the formatted turn), loss_from and loss_to (the code
    points of the segment under the loss mask; null but for assistants), attachments and attachment_tokens."""
    parts = F.coalesce(F.col(parts_col), F.array().cast(PARTS))
    content = F.array_join(F.transform(parts, _visit), "")
    head = F.concat(F.lit("[TURN "), escape(F.col(role_col)), F.lit("]"))
    out = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("_role"), head.alias("head"), content.alias("content"), F.filter(F.transform(parts, _attachment), lambda a: a["type"].isNotNull()).alias("attachments"))
    learnt = F.col("_role") == "assistant"
    return out.select(
        "conv_id", "turn", F.concat("head", "content", F.lit("</s>")).alias("segment"), F.when(learnt, F.length("head")).alias("loss_from"), F.when(learnt, F.length("head") + F.length("content")).alias("loss_to"),
        "attachments", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
    )


def read_back(segments: DataFrame) -> DataFrame:
    """What the formatted conversations say, read from their text in order: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    fields = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, turns, loss = None, hashlib.sha256(), hashlib.sha256()
        count = chars = size = 0
        for batch in batches:
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now is not None and now[0] != conv:
                    done.append((now[0], count, turns.hexdigest(), chars, loss.hexdigest(), size))
                    now = None
                if now is None:
                    now, turns, loss, count, chars, size = (conv,), hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                size += len(segment)
                for m in TURN.finditer(segment):
                    turns.update(f"{ESCAPED.sub(r'\1', m[1])}\n{ESCAPED.sub(r'\1', m[2])}\n".encode())
                    count += 1
                if start is not None:
                    text = ESCAPED.sub(r"\1", segment[start:end])
                    loss.update(text.encode())
                    chars += len(text)
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), fields, strict=True)], schema=fields)
                done = []
        if now is not None:
            done.append((now[0], count, turns.hexdigest(), chars, loss.hexdigest(), size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), fields, strict=True)], schema=fields)

    # The digest of a conversation needs its text in order, so a conversation is one stream; rows pass, none are gathered.
    dealt = segments.select("conv_id", "segment", "loss_from", "loss_to", "turn").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return dealt.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
