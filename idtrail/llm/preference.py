"""Preference pairs: the common turns of two conversations once as prompt, the rest as two masked completions.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SPANS = "array<struct<start:bigint,end:bigint>>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn.role, F.lit("\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t.text, F.lit(f"{CLOSE}\n"))), "")


def _trained(turns: Column, roles: tuple[str, ...]) -> Column:
    """Spans of the rendered turns that count in the loss: contents and end marks of ``roles``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc.at + F.length(_head(t))
        end = begin + F.length(t.text) + len(CLOSE)
        span = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(
            (end + 1).cast("long").alias("at"), F.when(t.role.isin(*roles), F.concat(acc.out, span)).otherwise(acc.out).alias("out")
        )

    return F.aggregate(turns, start, step, lambda acc: acc.out)


def preferences(turns: DataFrame, roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each ``pair_id`` of ``turns (pair_id, side, turn, role, text)``; ``side`` is ``chosen`` or ``rejected``.

    Returns ``pair_id, n_prompt`` (turns), ``prompt, chosen, rejected`` (rendered), ``chosen_mask, rejected_mask`` (spans of
    code points in the completion that are trained on: what ``roles`` say, with the end mark) and ``differs`` (both
    completions hold a trained span, so the pair can teach something).

    Turns go by ``turn``, ties by role and text; two turns are the same if role and text are. Null role or text: empty. Null
    turn: first. Null ``pair_id``: a pair of its own. Rows of another side are not part of either conversation. A side without
    rows is an empty conversation. Repeated rows are turns said twice. Control marks in a text are broken by a space, so that
    no text opens or closes a turn. The unit of output is a pair: two whole conversations, which fit in a row.
    """
    clean = [F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |")).alias(c) for c in ("role", "text")]
    said = turns.select("pair_id", "side", F.struct("turn", *clean).alias("said"))
    both = said.groupBy("pair_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("said")))).alias(s) for s in ("chosen", "rejected")]
    )
    # array_sort would put null turns last within equal structs; sort_array puts them first
    both = both.select("pair_id", *[F.sort_array(s).alias(s) for s in ("chosen", "rejected")])
    n = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", 1, n), F.slice("rejected", 1, n), lambda a, b: (a.role == b.role) & (a.text == b.text))
    stop = F.array_position(same, F.lit(False))
    both = both.withColumn("k", F.when(stop > 0, stop - 1).otherwise(n.cast("long")).cast("int"))
    rest = {s: F.slice(s, F.col("k") + 1, F.size(s)) for s in ("chosen", "rejected")}
    return both.select(
        "pair_id", F.col("k").cast("long").alias("n_prompt"), _render(F.slice("chosen", 1, F.col("k"))).alias("prompt"),
        *[_render(rest[s]).alias(s) for s in rest], *[_trained(rest[s], roles).alias(f"{s}_mask") for s in rest],
    ).withColumn("differs", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0))
