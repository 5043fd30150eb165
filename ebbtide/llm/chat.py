"""Conversations as one training text each, built and read back with Spark expressions only.

A formatted conversation is a sequence of blocks, one per run of turns with the same role::

    ### <role>:
    <text></turn>

Turns merged into one block are divided by ``</part>``.  Inside texts and roles a backslash becomes ``\\b``, ``<``
becomes ``\\l`` and ``#`` becomes ``\\h`` (in roles also a line end ``\\n``), so no text can open or end a block and
the turns can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.scratch import require

HEAD, BREAK, PART, END = "### ", ":\n", "</part>", "</turn>\n"
ASSISTANT = "assistant"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replace(_replace(_replace(text, "\\", "\\b"), "<", "\\l"), "#", "\\h")


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text leads a two-character code, so plain replacements cannot overlap."""
    return _replace(_replace(_replace(text, "\\l", "<"), "\\h", "#"), "\\b", "\\")


def escape_role(role: Column) -> Column:
    return _replace(escape(role), "\n", "\\n")


def unescape_role(role: Column) -> Column:
    return unescape(_replace(role, "\\n", "\n"))


def collect_turns(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, an array of (turn, role, text).

    Turns are sorted by turn (null first), then role and text, so ties have one order; repeated rows stay.  Null roles
    and texts are empty; rows with a null id form one conversation.  Other columns are not read.
    """
    require(rows, id_col, turn_col, role_col, text_col)
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def merge_adjacent(turns: Column) -> Column:
    """Runs of turns with one role as an array of (role, texts), in linear time: find where runs begin, then slice."""
    begins = F.filter(
        F.sequence(F.lit(1), F.size(turns)),
        lambda i: (i == 1) | (F.get(turns, i - 1)["role"] != F.get(turns, i - 2)["role"]),
    )
    ends = F.concat(F.slice(begins, 2, F.greatest(F.size(begins), F.lit(1))), F.array(F.size(turns) + 1))
    return F.zip_with(
        begins,
        ends,
        lambda begin, end: F.struct(
            F.get(turns, begin - 1)["role"].alias("role"),
            F.transform(F.slice(turns, begin, end - begin), lambda t: t["text"]).alias("texts"),
        ),
    )


def format_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans``: (start, length) in characters of every assistant text.

    Rows are gathered by ``collect_turns``, which states what nulls, ties and repeated rows give; no rows give no rows.
    One conversation becomes one row, so a single conversation must fit a string (2 GB); a corpus is spread by
    conversation.
    """
    turns = collect_turns(rows, id_col, turn_col, role_col, text_col)
    blocks = turns.select("conv_id", merge_adjacent(F.col("turns")).alias("blocks"))
    # Alternating pieces: what stands before a text, and the text itself.
    piece = "struct<lead:string,body:string,loss:boolean>"

    def pieces(block: Column) -> Column:
        opening = F.concat(F.lit(HEAD), escape_role(block["role"]), F.lit(BREAK))
        return F.transform(
            block["texts"],
            lambda text, i: F.struct(
                F.when(i == 0, opening).otherwise(F.lit(PART)).alias("lead"),
                F.concat(escape(text), F.when(i == F.size(block["texts"]) - 1, F.lit(END)).otherwise(F.lit(""))).alias(
                    "body"
                ),
                (block["role"] == ASSISTANT).alias("loss"),
            ).cast(piece),
        )

    flat = blocks.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    spans = F.expr(
        f"""aggregate(
          pieces,
          named_struct('at', 0L, 'spans', cast(array() as array<struct<start:bigint,length:bigint>>)),
          (s, p) -> named_struct(
            'at', s.at + length(p.lead) + length(p.body),
            'spans', if(p.loss, concat(s.spans, array(named_struct(
              'start', s.at + length(p.lead),
              'length', cast(length(p.body) - if(endswith(p.body, '</turn>\\n'), {len(END)}, 0) as bigint)))), s.spans)),
          s -> s.spans)"""
    )
    return flat.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["body"])), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """The turns read back from ``formatted``: ``conv_id``, ``turns`` (role, text), ``loss`` (texts under the mask)."""
    blocks = F.split("formatted", END)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        texts = F.split(F.substr(block, F.length(role) + 2), PART)
        role = F.substr(role, F.lit(len(HEAD) + 1), F.length(role) - len(HEAD) - 1)
        return F.transform(
            texts, lambda text: F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))
        )

    return formatted.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(blocks, turns)).alias("turns"),
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ).alias("loss"),
    )


def summarise(parsed: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss", "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
