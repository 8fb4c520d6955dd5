"""Prefix trie of conversations by a van Emde Boas recursion.

The trie of all sequences of turns is never walked turn by turn. Sequences are cut at half
depth: what stands above the cut is a sequence of an upper trie, what hangs below it is a
sequence of a lower forest, whose root is the cut prefix. Both halves are cut again, all upper
tries and all lower forests of a height in the same step, so that a trie of depth d takes
log2(d) steps.

* Naming, upwards: each aligned run of 2^j turns gets a name from the names of its two halves.
* Building, downwards: a piece is a distinct sequence under a distinct root, with the number and
  the least id of its conversations. A step cuts all pieces, names the cut prefixes by root and
  upper half, merges equal upper halves and hangs the lower halves under the cut's name. Pieces
  of one turn are the nodes.
* Grafting, upwards: totals (leaves, saved tokens) of lower tries are added up to the cut that
  they hang from, and from there to the tries of the next height. Each cut's total then goes
  down along the pieces that end at it, again halving, to the nodes that stand above it. The
  amounts of all cuts are summed wherever they meet, so no list of ancestors is ever written.

How it scales: rows are turns, runs of turns and pieces, never whole conversations, so one
conversation may hold any share of the turns. Turns are numbered over range partitions. Every
join is between keys that are unique on both sides, or between blocks of bounded size; sums
combine before the shuffle. A parent's id reaches its children, however many, by range
partitions too. A node's members are hashed in chunks of bounded size, in the order of ids; the
digest of one node is a stream through one task, as SHA-256 is. Steps are written to the shared
folder.

Defined results: turns stand by number (null first), then role, then text; repeated rows are
turns of their own. A null role or text is empty. Rows without a conversation id belong to no
conversation and are left out. Ids below zero are rebuilt by the remainder with the sign of the
id. Very long conversations and texts are read whole. Other columns, whatever their names, are
not read. An empty table has no nodes, not even a root. Names are 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import stored
from marginflow.operators.borders import AT, PID, fill_down, number_within, ordered_ranges

#: Turns of a conversation that one task joins with its header; ids of a chunk of members.
BLOCK, CHUNK = 4096, 4096
WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _root() -> Column:
    return F.unhex(F.lit("00" * 16))


def _name(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns_of(table: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, i, name, words): the turns of each conversation, numbered from 0."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t = table.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    t = t.withColumns({
        "name": _name(F.encode(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), "utf-8")),
        "words": F.regexp_count("text", F.lit(WORD)).cast("long"),
    })
    return number_within(t, ["conv"], [F.asc_nulls_first("turn"), "role", "text"], "i", keep=["conv", "name", "words"])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) in which conversation c begins with the first h turns of
    conversation c - c % 20 in place of its own, h = crc32(c) % 4."""
    turns = stored(turns, "trie-turns")
    sizes = stored(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    heads = sizes.filter("conv % 20 = 0").select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = sizes.withColumns({"base": F.expr("conv - conv % 20"), "h": F.crc32(F.col("conv").cast("string")) % 4})
    convs = convs.join(heads, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.select("conv", "base", "n", "h", "taken"), "trie-conversations")
    block = F.floor(F.col("i") / BLOCK)
    spread = convs.select("conv", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("block"))
    own = turns.withColumn("block", block).join(spread, ["conv", "block"]).filter(F.col("i") >= F.col("h"))
    own = own.select("conv", (F.col("i") - F.col("h") + F.col("taken")).alias("i"), "name", "words")
    first = turns.filter("i < 3 and conv % 20 = 0").select(F.col("conv").alias("base"), "i", "name", "words")
    head = convs.filter("taken > 0").select("conv", "base", "taken").join(first, "base").filter(F.col("i") < F.col("taken"))
    return convs.select("conv"), own.unionByName(head.select("conv", "i", "name", "words"))


def runs_of(turns: DataFrame, height: int) -> list[DataFrame]:
    """Per j up to ``height``, (conv, i, name, full, left, right, left_full): the i-th aligned
    run of 2^j turns (fewer at a conversation's end) and its halves."""
    none = F.lit(None).cast("binary")
    runs = [turns.select("conv", "i", "name", F.lit(True).alias("full"), none.alias("left"), none.alias("right"), F.lit(True).alias("left_full"))]
    for _ in range(height):
        odd = F.col("i") % 2 == 1
        of = lambda c, when: F.max(F.when(when, F.col(c)))
        r = runs[-1].select("conv", "i", "name", "full").groupBy("conv", F.floor(F.col("i") / 2).alias("i")).agg(
            of("name", ~odd).alias("left"), of("name", odd).alias("right"), F.coalesce(of("full", odd), F.lit(False)).alias("full"), of("full", ~odd).alias("left_full")
        )
        name = F.when(F.col("right").isNull(), _name(F.col("left"))).otherwise(_name(F.col("left"), F.col("right")))
        runs.append(stored(r.select("conv", "i", name.alias("name"), "full", "left", "right", "left_full"), "trie-runs"))
    return runs


def build(runs: list[DataFrame]) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """(nodes, steps). A node is (root, exit, i, n, conv, ending): its parent's and its own
    name, its depth less one, members, least member, and the sequence that ends there. Step j
    - 1 holds the cuts of height 2^j as (cut, root), and (exit, cut) of the pieces that fill
    it."""
    top = runs[-1].groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("full").alias("full"))
    whole = F.when(F.col("full"), _name(_root(), F.col("name")))
    pieces = stored(top.select(_root().alias("root"), "name", F.lit(0).cast("long").alias("i"), "n", "conv", whole.alias("exit"), F.col("name").alias("ending")), "trie-pieces")
    steps: list[tuple[DataFrame, DataFrame]] = []
    for below in reversed(runs[1:]):
        halves = pieces.join(below.select("conv", "i", "left", "right", "left_full"), ["conv", "i"])
        last = F.col("right").isNull()
        cut = F.when(F.col("left_full"), _name(F.col("root"), F.col("left")))
        halves = stored(halves.withColumn("cut", cut), "trie-halves")
        upper = halves.groupBy("root", F.col("left").alias("name")).agg(
            F.min(F.col("i") * 2).alias("i"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("cut").alias("exit"), F.max(F.when(last, F.col("ending"))).alias("ending")
        )
        lower = halves.filter(~last).select(F.col("cut").alias("root"), F.col("right").alias("name"), (F.col("i") * 2 + 1).alias("i"), "n", "conv", "exit", "ending")
        upper = stored(upper, "trie-upper")
        steps.append((
            upper.filter("exit is not null").select(F.col("exit").alias("cut"), "root"),
            halves.filter("exit is not null").select("exit", "cut"),
        ))
        pieces = upper.unionByName(lower)
    return pieces.select("root", "exit", "i", "n", "conv", "ending"), steps[::-1]


AMOUNTS = ("n_leaves", "saved_tokens")


def _summed(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(*[F.sum(a).alias(a) for a in AMOUNTS])


def grafted(own: DataFrame, steps: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(exit, root, amounts) of all nodes but the root with the amounts of their subtrees, from
    their own."""
    below = stored(_summed(own, "root"), "trie-below")  # of each root, within tries of the present height
    grafts = []
    for cuts, _ in steps:
        g = cuts.join(below.withColumnRenamed("root", "cut"), "cut")
        grafts.append(g)
        below = stored(_summed(below.unionByName(g.drop("cut")), "root"), "trie-below")
    extra = None  # of the pieces' ends, what hangs from there
    for (_, ends), g in zip(reversed(steps), reversed(grafts), strict=True):
        here = g.select(F.col("cut").alias("exit"), *AMOUNTS)
        if extra is not None:
            above = extra.join(ends, "exit").select(F.col("cut").alias("exit"), *AMOUNTS)
            here = here.unionByName(extra).unionByName(above)
        extra = stored(_summed(here, "exit"), "trie-extra")
    if extra is None:
        return own
    e = extra.select("exit", *[F.col(a).alias(f"_{a}") for a in AMOUNTS])
    return own.join(e, "exit", "left").select(*[c for c in own.columns if c not in AMOUNTS], *[(F.col(a) + F.coalesce(f"_{a}", F.lit(0))).alias(a) for a in AMOUNTS])


def member_digests(members: DataFrame) -> DataFrame:
    """Of (ending, conv): per ending, the SHA-256 of its ids in order, comma-joined. Ids are
    joined in chunks first; a chunk is all that one row holds."""
    r = ordered_ranges(members, ["ending", "conv"])
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = r.groupBy(PID, "ending", F.floor(F.col(AT) / CHUNK).alias("c")).agg(F.min("conv").alias("first"), ids.alias("ids"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending, digest = None, None
        for b in batches:
            names, out = [], []
            for e, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if e == ending:
                    digest.update(b"," + ids.encode())
                    continue
                if ending is not None:
                    names.append(ending)
                    out.append(digest.hexdigest())
                ending, digest = e, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.string())], ["ending", "ends_sha256"])
        if ending is not None:
            yield pa.RecordBatch.from_arrays([pa.array([ending], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["ending", "ends_sha256"])

    in_order = chunks.repartition(n, "ending").sortWithinPartitions("ending", "first").select("ending", "ids")
    return in_order.mapInArrow(run, "ending binary, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations (``convs``: all ids, ``turns``: conv, i, name,
    words), the root included."""
    turns = stored(turns, "trie-sequences")
    longest = turns.agg(F.coalesce(F.max("i") + 1, F.lit(0)).alias("n")).first().n
    runs = runs_of(turns, max(longest - 1, 0).bit_length())
    nodes, steps = build(runs)
    n_children = nodes.groupBy(F.col("root").alias("exit")).agg(F.count(F.lit(1)).alias("n_children"))
    own = nodes.join(n_children, "exit", "left").join(turns.select("conv", "i", "words"), ["conv", "i"])
    own = stored(own.select(
        "root", "exit", (F.col("i") + 1).alias("depth"), "n", "conv", "ending", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved_tokens"),
    ), "trie-nodes")
    whole = grafted(own, steps)
    # the root: its members are all conversations, its totals those of the nodes of depth 1
    tops = whole.filter("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), *[F.coalesce(F.sum(a), F.lit(0).cast("long")).alias(a) for a in AMOUNTS])
    everyone = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).filter("n > 0")
    root = everyone.crossJoin(F.broadcast(tops))  # one row and one row
    none = F.lit(None).cast("binary")
    root = root.select(
        none.alias("root"), _root().alias("exit"), F.lit(0).cast("long").alias("depth"), "n", "conv", _root().alias("ending"), "n_children",
        F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved_tokens",
    )
    whole = whole.select(root.columns).unionByName(root)
    turnless = convs.join(runs[-1].select("conv"), "conv", "left_anti").select(_root().alias("ending"), "conv")
    digests = member_digests(runs[-1].select(F.col("name").alias("ending"), "conv").unionByName(turnless))
    whole = stored(whole.join(digests, "ending", "left"), "trie-totals")
    # every node beside its children: the parent's id comes down to them
    heirs = whole.withColumns({"key": F.col("root"), "given": F.lit(None).cast("long")})
    givers = whole.withColumns({"key": F.col("exit"), "given": F.col("conv")})
    lines = givers.withColumn("child", F.lit(False)).unionByName(heirs.withColumn("child", F.lit(True)))
    got = fill_down(lines, ["key"], ["child", "exit"], "given", "parent_conv_id").filter("child")
    return got.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def prefix_trie(table: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    return trie(*rebuilt(turns_of(table)))
