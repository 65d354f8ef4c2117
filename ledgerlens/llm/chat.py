"""Chat formatting: multi-party perspective rotation.

Every participant of a dialogue gets a rendering of it in which their turns are the assistant's and everybody else's are
a user's with a name; turns of SYSTEM speakers stand in all of them as they are and have no rendering of their own. The
spans of a rendering are where its assistant speaks (code points from 0, end excluded, with the closing mark): the parts
to train on.

A dialogue is one row per turn; turns are put in order by number, then speaker, then text, nulls first. A rendering comes in parts
of PART turns, so no group grows without bound: every participant of the dialogue has all its parts, spoken in or not, and
the spans count from the beginning of the whole rendering. Turns are numbered by ranges of the order (rows of a range, those of the
ranges before), and a part's place is the sum of the lengths of the parts before it. `whole` puts the parts of a rendering together.
Null texts are empty turns; a null speaker is a participant named "unknown"; turns without a dialogue id form one dialogue
with a null id. Repeated rows are repeated turns. Marks inside texts and names lose their form (`<|im_` gets a blank), so
no text can close its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, ASSISTANT, USER = "system", "assistant", "user name="
UNKNOWN = "unknown"
PART = 1000


def _safe(x: Column) -> Column:
    return F.replace(x, F.lit("<|im_"), F.lit("<| im_"))


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with __n, the place of each turn in its dialogue; a dialogue may lie in any number of ranges."""
    order = ["__t", "__s", "__x"]
    # Written once: another run of the ranges could cut elsewhere.
    ranged = saved(rows.repartitionByRange("__d", *order).withColumn("__r", F.spark_partition_id()), "turns")
    before = F.coalesce(F.sum("__c").over(Window.partitionBy("__d").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranged.groupBy("__d", "__r").agg(F.count(F.lit(1)).alias("__c")).select("__d", "__r", before.alias("__before"))
    # Only dialogues that go on in a further range need the join.
    starts = starts.where("__before > 0").select(F.col("__d").alias("__e"), F.col("__r").alias("__q"), "__before")
    joined = ranged.join(starts, F.col("__d").eqNullSafe(F.col("__e")) & (F.col("__r") == F.col("__q")), "left")
    place = F.row_number().over(Window.partitionBy("__d", "__r").orderBy(*order)) - 1
    return joined.withColumn("__n", place + F.coalesce("__before", F.lit(0))).drop("__r", "__e", "__q", "__before")


def rotate(df: DataFrame, dialogue: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """One row per dialogue, participant and part: dialogue, part, participant, n_turns (of the part), rendered, spans (array of start, end)."""
    name = _safe(F.coalesce(F.col(speaker).cast("string"), F.lit(UNKNOWN)))
    rows = df.select(F.col(dialogue).alias("__d"), F.col(turn).alias("__t"), name.alias("__s"), _safe(F.coalesce(F.col(text), F.lit(""))).alias("__x"))
    part = F.floor(F.col("__n") / PART).alias("part")
    turns = _numbered(rows).groupBy("__d", part).agg(F.array_sort(F.collect_list(F.struct("__n", "__s", "__x"))).alias("__all"))
    turns = saved(turns, "parts")

    # A part's length for each participant, without its texts: as if all were users, corrected where the participant speaks.
    mark = F.length(F.lit(START)) + F.length(F.lit(END)) + 2
    role = lambda s: F.when(s == SYSTEM, F.length(F.lit(SYSTEM))).otherwise(F.length(s) + len(USER))
    told = F.aggregate("__all", F.lit(0).cast("long"), lambda a, t: a + mark + role(t["__s"]) + F.length(t["__x"]))
    sizes = turns.select("__d", "part", told.alias("__told"))
    said = turns.select("__d", "part", F.explode("__all.__s").alias("participant")).where(F.col("participant") != SYSTEM)
    said = said.groupBy("__d", "part", "participant").agg(F.count(F.lit(1)).alias("__own"))
    people = said.select(F.col("__d").alias("__e"), "participant").distinct()
    each = sizes.join(people, F.col("__d").eqNullSafe(F.col("__e"))).drop("__e")
    said = said.select(F.col("__d").alias("__e"), F.col("part").alias("__p"), F.col("participant").alias("__q"), "__own")
    each = each.join(said, F.col("__d").eqNullSafe(F.col("__e")) & (F.col("part") == F.col("__p")) & (F.col("participant") == F.col("__q")), "left").drop("__e", "__p", "__q")
    length = F.col("__told") + F.coalesce("__own", F.lit(0)) * (len(ASSISTANT) - len(USER) - F.length("participant"))
    line = Window.partitionBy("__d", "participant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(F.col("__d").alias("__e"), F.col("part").alias("__p"), "participant", F.coalesce(F.sum(length).over(line), F.lit(0)).alias("__at"))
    each = turns.join(each, F.col("__d").eqNullSafe(F.col("__e")) & (F.col("part") == F.col("__p")))

    def own(t: Column) -> Column:
        return t["__s"] == F.col("participant")

    def head(t: Column) -> Column:
        role = F.when(own(t), F.lit(ASSISTANT)).when(t["__s"] == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit(USER), t["__s"]))
        return F.concat(F.lit(START), role, F.lit("\n"))

    pieces = F.transform("__all", lambda t: F.struct(own(t).alias("own"), head(t).alias("head"), F.concat(t["__x"], F.lit(END)).alias("body")))
    each = each.withColumn("__pieces", pieces)
    rendered = F.array_join(F.transform("__pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    # Where each turn begins: running sum of the lengths before it.
    ends = F.aggregate(
        "__pieces", F.struct(F.col("__at").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"]) + 1).alias("at"),
            F.when(p["own"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(p["head"])).alias("start"), (a["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end")))))
            .otherwise(a["spans"]).alias("spans")))
    return each.select(F.col("__d").alias(dialogue), "part", "participant", F.size("__all").cast("long").alias("n_turns"),
                       rendered.alias("rendered"), ends["spans"].alias("spans"))


def whole(parts: DataFrame, dialogue: str = "conv_id") -> DataFrame:
    """The parts of each rendering as one row: dialogue, participant, n_turns, rendered, spans. A rendering must fit a string (2 GB)."""
    held = F.array_sort(F.collect_list(F.struct("part", "n_turns", "rendered", "spans")))
    joined = parts.groupBy(dialogue, "participant").agg(F.sum("n_turns").alias("n_turns"), held.alias("__parts"))
    return joined.select(dialogue, "participant", "n_turns", F.array_join("__parts.rendered", "").alias("rendered"), F.flatten("__parts.spans").alias("spans"))
