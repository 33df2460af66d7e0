"""Preference pairs from conversations: the common turns once as the prompt, what differs as two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.fingerprints import with_next

#: The marks around a turn, and the role that is learnt from.
BEGIN, END, LEARNT = "<|im_start|>", "<|im_end|>\n", "assistant"


def common_turns(a: Column, b: Column) -> Column:
    """Number of turns at the start of both that are equal in role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same).cast("long")).otherwise(first - 1).cast("int")


def render(turns: Column) -> Column:
    """Each turn as begin mark, role, line break, text, end mark."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(BEGIN), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")


def mask(turns: Column) -> Column:
    """Lengths in characters of a rendering's stretches and whether each is learnt from (1) or not (0): head and body of each turn."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        (F.length(t["role"]) + F.lit(len(BEGIN) + 1)).cast("string"), F.lit(":0,"),
        (F.length(t["text"]) + F.lit(len(END))).cast("string"), F.when(t["role"] == LEARNT, F.lit(":1")).otherwise(F.lit(":0")))), ",")


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order of turn (nulls first), role and text; null roles and texts are empty.

    Rows that repeat a turn are turns of their own. Rows without a conv_id make up one conversation without an id.
    """
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.select("conv_id", row.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))


def formatted(pairs: DataFrame) -> DataFrame:
    """pairs (with arrays of turns `chosen` and `rejected`) with n_common, prompt, chosen, chosen_mask, rejected, rejected_mask.

    A pair of equal conversations has empty completions. Where one side is null there is no prompt, and the other is
    rendered whole.
    """
    n = F.coalesce("n_common", F.lit(0))

    def rest(side: str) -> Column:
        return F.slice(F.col(side), n + 1, F.greatest(F.size(side) - n, F.lit(0)))

    both = F.col("chosen").isNotNull() & F.col("rejected").isNotNull()
    counted = pairs.withColumn("n_common", F.when(both, common_turns(F.col("chosen"), F.col("rejected"))))
    return (counted.withColumn("prompt", F.when(both, render(F.slice("chosen", F.lit(1), n))))
            .withColumn("__c", rest("chosen")).withColumn("__r", rest("rejected"))
            .withColumn("chosen", render(F.col("__c"))).withColumn("chosen_mask", mask(F.col("__c")))
            .withColumn("rejected", render(F.col("__r"))).withColumn("rejected_mask", mask(F.col("__r"))).drop("__c", "__r"))


def with_other_reply(conversations: DataFrame, blocks: int | None = None) -> DataFrame:
    """(conv_id, chosen, rejected): each conversation, and itself with its last learnt turn replaced by that of the next conversation.

    Next: by ascending conv_id (nulls first), after the last the first; so a table of one conversation has pairs of
    equal ones. A conversation without a learnt turn gets the other's reply as one turn more; a next one without any
    gives an empty reply.
    """
    blocks = blocks or 4 * int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    roles = F.transform("turns", lambda t: t["role"])
    back = F.array_position(F.reverse(roles), F.lit(LEARNT))
    at = F.when(back > 0, F.size("turns") - back.cast("int")).otherwise(F.size("turns"))
    placed = conversations.withColumn("at", at).withColumn("reply", F.coalesce(F.get("turns", F.col("at"))["text"], F.lit("")))
    swapped = with_next(placed, "conv_id", ["reply"], blocks)
    other = F.array(F.struct(F.lit(LEARNT).alias("role"), F.col("next_reply").alias("text")))
    rejected = F.concat(F.slice("turns", F.lit(1), F.col("at")), other, F.slice("turns", F.col("at") + 2, F.size("turns")))
    return swapped.select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


def preferences(turns: DataFrame) -> DataFrame:
    """Formatted pairs of all conversations of a table (conv_id, turn, role, text)."""
    return formatted(with_other_reply(conversations_of(turns))).select(
        "conv_id", "n_common", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")
