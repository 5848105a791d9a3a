"""Preference formatting of chosen and rejected conversations.

A pair has two sides of turns.  The longest common turn prefix is rendered once
as prompt; the turns after it are the two completions, with a mask over what a
model learns: the content and end marker of assistant turns, not their headers
and not turns of others.

Everything is joins and partial aggregates on (pair, turn, role, text) counts:
no side is gathered into one row, so a conversation of any length, or one that
holds a third of all rows, is spread over many tasks.  The output has one row
per pair, part and turn; ``records`` puts small pairs into one row each.

Defined cases: null role or text is empty; a null turn comes before all others;
several rows at one turn are one step of the conversation, compared as a bag
and given with their number of ``copies``; pairs with equal sides are prompt
only; a side that is missing leaves an empty prompt; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = -(2**63)


@dataclass(frozen=True)
class Template:
    """Marker strings; ``guard`` breaks them up where a text contains them."""

    open: str = "<|im_start|>"
    head_end: str = "\n"
    close: str = "<|im_end|>\n"
    guard: tuple[str, str] = ("<|", "< |")


def rendered(template: Template) -> tuple[Column, Column]:
    """Header and body of a turn."""
    safe = lambda c: F.replace(F.col(c), F.lit(template.guard[0]), F.lit(template.guard[1]))
    head = F.concat(F.lit(template.open), safe("role"), F.lit(template.head_end))
    return head, F.concat(safe("text"), F.lit(template.close))


def preference_segments(
    sides: DataFrame, template: Template = Template(), trained_role: str = "assistant"
) -> DataFrame:
    """Rendered turns of prompt, chosen and rejected part.

    ``sides``: pair_id, side (``chosen`` or ``rejected``), turn, role, text.
    ``mask_start`` and ``mask_length`` give the characters learned from.
    """
    turns = sides.select(
        F.col("pair_id").cast("long").alias("pair_id"), "side", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    counted = turns.groupBy("pair_id", "turn", "role", "text").agg(
        F.count_if(F.col("side") == "chosen").alias("chosen"),
        F.count_if(F.col("side") == "rejected").alias("rejected"),
    )
    place = F.coalesce("turn", F.lit(FIRST))
    parting = counted.groupBy(F.col("pair_id").alias("of")).agg(
        F.min(F.when(F.col("chosen") != F.col("rejected"), place)).alias("parting")
    )
    shared = F.col("parting").isNull() | (place < F.col("parting"))
    parts = F.array(
        F.struct(F.lit("prompt").alias("part"), F.when(shared, F.col("chosen")).alias("copies")),
        F.struct(F.lit("chosen").alias("part"), F.when(~shared, F.col("chosen")).alias("copies")),
        F.struct(F.lit("rejected").alias("part"), F.when(~shared, F.col("rejected")).alias("copies")),
    )
    head, body = rendered(template)
    learned = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return (
        counted.join(parting, F.col("pair_id").eqNullSafe(F.col("of")))
        .select("pair_id", "turn", "role", "text", F.inline(F.filter(parts, lambda p: p["copies"] > 0)))
        .select("pair_id", "part", "turn", "copies", "role", head.alias("head"), body.alias("body"), learned.alias("learned"))
        .select(
            "pair_id", "part", "turn", "copies", "role", F.concat("head", "body").alias("rendered"),
            F.when(F.col("learned"), F.length("head")).otherwise(0).alias("mask_start"),
            F.when(F.col("learned"), F.length("body")).otherwise(0).alias("mask_length"),
        )
    )


def records(segments: DataFrame) -> DataFrame:
    """One row per pair, for pairs that fit into a row: texts and masked spans.

    Spans are (start, length) within the completion; copies are repeated.
    """
    order = F.struct(
        F.coalesce("turn", F.lit(FIRST)).alias("place"), "role", "rendered", "mask_start", "mask_length"
    )
    steps = segments.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    gathered = steps.groupBy("pair_id").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("part") == p, order))).alias(p)
        for p in ("prompt", "chosen", "rejected")
    ])
    text = lambda p: F.array_join(F.transform(p, lambda s: s["rendered"]), "")

    def spans(p: str) -> Column:
        empty = F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
        )
        add = lambda a, s: F.struct(
            (a["at"] + F.length(s["rendered"])).alias("at"),
            F.when(
                s["mask_length"] > 0,
                F.array_append(a["spans"], F.struct((a["at"] + s["mask_start"]).alias("start"), s["mask_length"].alias("length"))),
            ).otherwise(a["spans"]).alias("spans"),
        )
        return F.aggregate(p, empty, add, lambda a: a["spans"])

    return gathered.select(
        "pair_id", text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
        spans("chosen").alias("chosen_spans"), spans("rejected").alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame, reply_role: str = "assistant") -> DataFrame:
    """Two sides for every conversation, for tables without judged replies.

    Chosen is the conversation; rejected is the same with its last reply
    replaced by that of the neighbour, the conversation whose id differs in the
    lowest bit (an empty reply, if it has none).  A conversation without reply
    has equal sides.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    place = F.coalesce("turn", F.lit(FIRST))
    replies = (
        turns.where(F.col("role") == reply_role)
        .groupBy("pair_id")
        .agg(F.max(F.struct(place.alias("place"), "text")).alias("last"))
    )
    swaps = replies.select(F.col("pair_id").alias("of"), F.col("last.place").alias("place")).join(
        replies.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("of"), F.col("last.text").alias("other")), "of", "left"
    )
    both = turns.join(swaps, F.col("pair_id").eqNullSafe(F.col("of")), "left")
    swapped = (F.col("role") == reply_role) & place.eqNullSafe(F.col("place"))
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("said")),
        F.struct(
            F.lit("rejected").alias("side"),
            F.when(swapped, F.coalesce("other", F.lit(""))).otherwise(F.col("text")).alias("said"),
        ),
    )
    return both.select("pair_id", "turn", "role", F.inline(sides)).withColumnRenamed("said", "text")
