"""Chat formatting by multi-party perspective rotation.

Every participant of a conversation gets a rendering of the dialogue in which
their own turns are the assistant's, the others' are those of named users,
and system messages stay what they are.  The mask holds the spans (code
points, end exclusive) of the assistant's words, the ones to learn from.

A dialogue is rendered in parts of at most ``PART`` turns, so that one of any
length never becomes one row; all but very long ones have a single part.
Parts are cut by a turn's place in its dialogue, however turns are numbered.
The place is found in two steps, so that a dialogue of any length is no
task of its own: its turn numbers are dealt to ranges of about ``PART`` turns,
whose counts and lengths are summed up; inside a range a window reads the
turns in order and spills.  Only the turns of one part are ever gathered.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns rendered in one row.
PART = 512
SYSTEM = "system"
# The markers of the format.
OPEN, NAME, CLOSE = "<|{role}|>\n", "<|user name={name}|>\n", "\n<|end|>\n"


def header(speaker: Column) -> Column:
    """The header of a turn as others see it: a named user, or the system."""
    named = F.concat(F.lit(NAME.split("{name}")[0]), speaker, F.lit(NAME.split("{name}")[1]))
    return F.when(speaker == SYSTEM, F.lit(OPEN.format(role=SYSTEM))).otherwise(named)


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, perspective, n_turns, n_trained, rendered, mask`` for every participant.

    Turns are ordered by (turn, role, text), nulls first; turns of one number
    are in one range.  A null role is the speaker ``unknown``; a null text is
    empty.  Rows without a conv_id are one conversation; repeated rows are
    turns of their own.  A conversation with system messages alone has no
    participant and gives no row.  Other columns are not read; an empty table
    gives no rows.
    """
    slim = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("said"))
    slim = slim.withColumns({"none": F.col("conv_id").isNull(), "conv": F.coalesce("conv_id", F.lit(0).cast("long")),
                             "size": F.length(header(F.col("speaker"))) + F.length("said") + F.lit(len(CLOSE))})
    dialogue = ["none", "conv"]
    number = F.col("turn").cast("double")
    spans = slim.groupBy(*dialogue).agg(F.min(number).alias("low"), F.max(number).alias("high"), F.count(F.lit(1)).alias("n"))
    # about as many turns a range as a part has, whatever the numbers' distances; turns without a number are the first range
    block = F.coalesce(F.floor((number - F.col("low")) / (F.col("high") - F.col("low") + 1) * F.col("n") / part), F.lit(-1).cast("long"))
    ranged = slim.join(spans, dialogue).withColumn("block", block).drop("low", "high", "n")
    earlier = Window.partitionBy(*dialogue).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*dialogue, "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
               .select(*dialogue, "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size_before")))
    order = Window.partitionBy(*dialogue, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "said")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({"row": F.row_number().over(order) - 1, "upto": F.coalesce(F.sum("size").over(before), F.lit(0))})
    placed = (inside.join(offsets, [*dialogue, "block"])
              .withColumns({"place": F.col("n_before") + F.col("row"), "at": F.col("size_before") + F.col("upto")})
              .withColumn("cut", F.floor(F.col("place") / part)))
    parts = (placed.groupBy("conv_id", "cut")
             .agg(F.array_sort(F.collect_list(F.struct("place", "speaker", "said", "at"))).alias("turns")))
    speakers = slim.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    both = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of")))

    own_header = OPEN.format(role="assistant")
    mine = lambda t: t["speaker"] == F.col("perspective")
    text = F.concat_ws("", F.transform("turns", lambda t: F.concat(F.when(mine(t), F.lit(own_header)).otherwise(header(t["speaker"])), t["said"], F.lit(CLOSE))))
    # an own turn starts where it would as a user's, moved by the difference of the headers of the own turns before it
    shift = F.lit(len(own_header)) - F.length(header(F.col("perspective")))
    begin = F.get("turns", F.lit(0))["at"]
    start = lambda t, k: t["at"] - begin + shift * k + F.lit(len(own_header))
    own = F.filter("turns", mine)
    mask = F.concat_ws(",", F.transform(own, lambda t, k: F.concat_ws(":", start(t, k).cast("string"), (start(t, k) + F.length(t["said"])).cast("string"))))
    return both.select(
        "conv_id", F.col("cut").cast("long").alias("part"), "perspective",
        F.size("turns").cast("long").alias("n_turns"), F.size(own).cast("long").alias("n_trained"), text.alias("rendered"), mask.alias("mask"))


def oracle_sql(part: int = PART) -> str:
    """DuckDB SQL for ``rotate`` over the conversations table."""
    return f"""
    with t as (
      select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as said from conversations),
    p as (
      select *, row_number() over (partition by conv_id order by turn nulls first, speaker, said) - 1 as place from t),
    c as (select *, place // {part} as cut from p),
    who as (select distinct conv_id as of_conv, speaker as perspective from t where speaker <> '{SYSTEM}'),
    r as (
      select c.*, perspective, speaker = perspective as mine,
        case when speaker = perspective then '<|assistant|>' when speaker = '{SYSTEM}' then '<|{SYSTEM}|>' else '<|user name=' || speaker || '|>' end || chr(10) as head
      from c join who on conv_id is not distinct from of_conv),
    o as (
      select *, coalesce(sum(length(head) + length(said) + {len(CLOSE)}) over (partition by conv_id, cut, perspective order by place
                rows between unbounded preceding and 1 preceding), 0) + length(head) as start from r)
    select conv_id, cut::bigint as part, perspective, count(*)::bigint as n_turns, count(*) filter (mine)::bigint as n_trained,
      string_agg(head || said || chr(10) || '<|end|>' || chr(10), '' order by place) as rendered,
      coalesce(string_agg(start::bigint || ':' || (start + length(said))::bigint, ',' order by place) filter (mine), '') as mask
    from o group by conv_id, cut, perspective
    """
