"""Preference pairs: one prompt, two masked completions.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (equal
role and text) is rendered once, as the prompt. What follows in each is its completion, as
segments with a mask: the text of assistant turns and the marker that ends them is trained,
all else (other roles, headers) is not. All steps are DataFrame functions over a row per
conversation or pair.

``pairs_of`` makes pairs for a table that has none: conversations that begin with the same
turn are alternatives, and each is chosen over the next one by id; the pairs are as many as
the conversations, not their square. Ids alone are numbered in the order of first turn and id,
range by range, so a first turn that a third of all conversations share is spread over many
tasks however its ids lie; turns are joined on by id afterwards. A conversation without a next
one is chosen over itself with the last assistant turn replaced by its first (left out where it
has one only).

Defined results: turns stand by number, then role, then text; exact repetitions of a turn row
count once. A null text is empty, a null role is "none". Rows without a conversation id are
each a conversation of their own. Equal conversations share all turns and have empty
completions (``tie``). A conversation without an assistant turn, chosen over itself, is a tie
too. Marker strings inside a text are broken by a space, so that no text can end its turn. Very
long texts and conversations are rendered whole. Other columns, whatever their names, are not read.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import stored
from marginflow.operators.windows import global_index

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def conversations_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns): a row per conversation with its turns (role, text) in order."""
    t = turns.select(
        F.col(id_col).alias("conv"),
        F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).alias("alone"),
        F.struct(
            F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("none")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    c = t.groupBy("conv", "alone").agg(F.sort_array(F.collect_set("t")).alias("t"))
    return c.select("conv", F.transform("t", lambda x: F.struct(x.getField("role").alias("role"), x.getField("text").alias("text"))).alias("turns"))


def next_ids(conversations: DataFrame) -> DataFrame:
    """(conv, next): of each conversation, the next one by id that begins with the same turn;
    no row where there is none."""
    first = F.col("turns")[0]
    key = F.sha2(F.concat(first.getField("role"), F.lit("\n"), first.getField("text")), 256)
    ids = conversations.filter(F.col("conv").isNotNull()).select(key.alias("first"), "conv")
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here = global_index(ids, [F.col("first"), F.col("conv")], "at", n)
    after = here.select((F.col("at") - 1).alias("at"), "first", F.col("conv").alias("next"))
    return here.join(after, ["at", "first"]).select("conv", "next")


def pairs_of(conversations: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id, chosen, rejected); ``rejected_id`` is null where the rejected
    conversation is made from the chosen one. The conversations are written once and read by
    all three uses."""
    conversations = stored(conversations, "preference-conversations")
    named = lambda c: F.concat(F.lit("="), F.col(c).cast("string"))
    # rows without an id, or without a next one, have join keys of their own that match nothing
    own_key = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    c = conversations.withColumn("_key", F.coalesce(named("conv"), own_key))
    c = c.join(next_ids(conversations).select(named("conv").alias("_key"), F.col("next").alias("next_id")), "_key", "left")
    c = c.withColumn("_key", F.coalesce(named("next_id"), F.concat(F.lit("-"), F.col("_key"))))
    others = conversations.filter(F.col("conv").isNotNull()).select(named("conv").alias("_key"), F.col("turns").alias("next_turns"))
    c = c.join(others, "_key", "left").drop("_key")
    kinds = F.transform("turns", lambda x: x.getField("role") == TRAINED)
    head, last = F.array_position(kinds, F.lit(True)), F.size("turns") + 1 - F.array_position(F.reverse(kinds), F.lit(True))
    c = c.withColumns({"head": head, "last": last})
    swap = F.when(F.col("head") < F.col("last"), F.array(F.get("turns", (F.col("head") - 1).cast("int")))).otherwise(F.slice("turns", 1, 0))
    own = F.when(F.col("head") == 0, F.col("turns")).otherwise(
        F.concat(F.slice("turns", F.lit(1), (F.col("last") - 1).cast("int")), swap, F.slice("turns", (F.col("last") + 1).cast("int"), F.size("turns")))
    )
    return c.select(
        F.col("conv").alias("chosen_id"), F.col("next_id").alias("rejected_id"), F.col("turns").alias("chosen"),
        F.when(F.col("next_id").isNotNull(), F.col("next_turns")).otherwise(own).alias("rejected"),
    )


def _clean(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(START), F.lit("<| im_start|>")), F.lit(END), F.lit("<| im_end|>"))


def _header(t: Column) -> Column:
    return F.concat(F.lit(START), _clean(t.getField("role")), F.lit("\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _clean(t.getField("text")), F.lit(END + "\n"))), "")


def _segments(turns: Column) -> Column:
    """(text, trained) runs: header, then text with the end marker, then the line's end."""
    trained = lambda t: t.getField("role") == TRAINED
    seg = lambda text, mask: F.struct(text.alias("text"), mask.alias("trained"))
    return F.flatten(
        F.transform(turns, lambda t: F.array(seg(_header(t), F.lit(False)), seg(F.concat(_clean(t.getField("text")), F.lit(END)), trained(t)), seg(F.lit("\n"), F.lit(False))))
    )


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Of (chosen_id, rejected_id, chosen, rejected): the ids, ``n_shared`` turns, ``tie``,
    ``prompt``, and ``chosen`` and ``rejected`` as segments (text, trained)."""
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    differ = F.array_position(same, F.lit(False))
    p = pairs.withColumn("n_shared", F.when(differ == 0, F.size("chosen")).otherwise(differ - 1).cast("int"))
    rest = lambda c: F.slice(F.col(c), F.col("n_shared") + 1, F.size(c))
    return p.select(
        "chosen_id", "rejected_id", F.col("n_shared").cast("long").alias("n_shared"),
        ((F.size("chosen") == F.col("n_shared")) & (F.size("rejected") == F.col("n_shared"))).alias("tie"),
        _rendered(F.slice("chosen", F.lit(1), F.col("n_shared"))).alias("prompt"),
        _segments(rest("chosen")).alias("chosen"), _segments(rest("rejected")).alias("rejected"),
    )


def flat(formatted: DataFrame) -> DataFrame:
    """Completions as one string each, with their masks as ``trained:code points`` runs."""
    text = lambda c: F.array_join(F.transform(c, lambda s: s.getField("text")), "")
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.getField("trained").cast("int").cast("string"), F.char_length(s.getField("text")).cast("string"))), ",")
    return formatted.select(
        "chosen_id", "rejected_id", "n_shared", "tie", "prompt", text("chosen").alias("chosen"), mask("chosen").alias("chosen_mask"),
        text("rejected").alias("rejected"), mask("rejected").alias("rejected_mask"),
    )
