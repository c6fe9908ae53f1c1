"""Chat formatting after cumulative-snapshot collapse.  DataFrame operations only.

A log often holds a conversation many times, each time with more turns.  Rolling hashes of turn
prefixes tell which conversations are a prefix of a longer one: the hash of the first n turns is
the exclusive or of 128 bits for each (position, role, text), so it can be summed in parts.  A
conversation whose whole hash is also the hash of a longer one's prefix is dropped by an anti-join;
of equal conversations the least conv_id stays.  What is left is rendered.

Turns are taken in order of ``turn``, then of a hash of role and text.  Conversations are summed
and rendered in parts of ``part_turns`` turn numbers, so one of any length never lies in one task
or one row; an ordinary conversation is one part, number 0.  A part with more than ``most`` rows, because very many
have one turn number or none, falls into pieces by turn number and by ranges of the hash that orders equal numbers:
their texts, in order of (part, piece_turn, piece), are the conversation's.

Edge cases: a null conv_id is one conversation, counted as the greatest id; null turns come last,
in a part of their own (null); null roles and texts differ from empty ones and are rendered as
empty; exact repeats of a turn (same number, role and text) count once; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fragloom.llm.spans import picked
from fragloom.storage import materialise

PART_TURNS, MOST = 256, 8192
#: What a part, or a piece of one, is known by.
PIECE = ["conv", "part", "piece_turn", "piece"]
LAST = (1 << 63) - 1


def _hash(lane: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(lane), *columns)


def keyed_turns(turns: DataFrame, part_turns: int) -> DataFrame:
    """conv, turn, part, role, text and two hash lanes of role and text."""
    role, text = F.col("role").cast("string"), F.col("text").cast("string")
    content = [role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit(""))]
    turn = F.col("turn").cast("bigint")
    return picked(turns, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(LAST)).alias("conv"),
        F.coalesce(turn, F.lit(LAST)).alias("turn"),
        F.floor(F.coalesce(turn, F.lit(LAST)) / part_turns).alias("part"),
        role.alias("role"), text.alias("text"), _hash(1, *content).alias("x"), _hash(2, *content).alias("y"),
    )


def in_pieces(turns: DataFrame, most: int) -> DataFrame:
    """turns with piece_turn and piece, 0 for parts of at most so many rows."""
    counts = turns.groupBy("conv", "part").agg(F.count("*").alias("rows")).where(F.col("rows") > most)
    large = materialise(counts.select("conv", "part", F.ceil(F.col("rows") / most).alias("ranges")))
    share = F.floor((F.col("x") / 2.0**64 + 0.5) * F.col("ranges"))  # grows with x
    dealt = turns.join(large, ["conv", "part"], "left")
    piece_turn = F.when(F.col("ranges").isNotNull(), F.col("turn")).otherwise(0).cast("bigint")
    return dealt.withColumns({"piece_turn": piece_turn, "piece": F.coalesce(share, F.lit(0)).cast("bigint")}).drop("ranges")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv, n, x, y: the hash of the first n turns, for every turn.  turns: in_pieces()."""
    turns = turns.select(*PIECE, "turn", "x", "y").distinct()
    here = Window.partitionBy(*PIECE).orderBy("turn", "x", "y")
    sums = turns.groupBy(*PIECE).agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy(*PIECE[1:]).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*PIECE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = turns.withColumn("at", F.row_number().over(here)).join(bases, PIECE)
    placed = placed.withColumn("at", F.col("base") + F.col("at"))
    placed = placed.select(*PIECE, "at", _hash(3, F.col("at"), F.col("x")).alias("x"), _hash(4, F.col("at"), F.col("y")).alias("y"))
    parts = placed.groupBy(*PIECE).agg(F.expr("bit_xor(x)").alias("px"), F.expr("bit_xor(y)").alias("py"))
    none = F.lit(0).cast("bigint")
    parts = parts.select(*PIECE, *(F.coalesce(F.expr(f"bit_xor({c})").over(before), none).alias(c) for c in ("px", "py")))
    running = Window.partitionBy(*PIECE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.select(*PIECE, "at", F.expr("bit_xor(x)").over(running).alias("x"), F.expr("bit_xor(y)").over(running).alias("y"))
    joined = inside.join(parts, PIECE)
    return joined.select("conv", F.col("at").alias("n"), F.col("x").bitwiseXOR(F.col("px")).alias("x"), F.col("y").bitwiseXOR(F.col("py")).alias("y"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv, n_turns of the conversations that are no prefix of another, one of each."""
    every = materialise(prefixes(turns))
    lengths = every.groupBy("conv").agg(F.max("n").alias("length"))
    marked = every.join(lengths, "conv")
    whole = marked.where("n = length").groupBy("n", "x", "y").agg(F.min("conv").alias("conv"))
    proper = marked.where("n < length").select("n", "x", "y").distinct()
    return whole.join(proper, ["n", "x", "y"], "left_anti").select("conv", F.col("n").alias("n_turns"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame, part_turns: int = PART_TURNS, most: int = MOST) -> DataFrame:
    """conv_id, part, piece_turn, piece (0 in parts of at most ``most`` rows), n_turns (of the whole conversation), text, for the conversations that no longer one holds."""
    keyed = in_pieces(keyed_turns(turns, part_turns), most)
    kept = maximal(keyed)
    rows = keyed.select(*PIECE, "turn", "x", "y", render(F.col("role"), F.col("text")).alias("text")).join(kept, "conv")
    parts = rows.groupBy(*PIECE, "n_turns").agg(F.array_sort(F.collect_set(F.struct("turn", "x", "y", "text"))).alias("all"))
    text = F.array_join(F.transform("all", lambda t: t["text"]), "")
    last = F.floor(F.lit(LAST) / part_turns)
    return parts.select(F.when(F.col("conv") != LAST, F.col("conv")).alias("conv_id"), F.when(F.col("part") != last, F.col("part")).alias("part"), "piece_turn", "piece", "n_turns", text.alias("text"))


def query(spark, sf_dir):
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("piece_turn", "piece")


#: Prefixes as lists of their turns, compared as they are.
SQL = r"""
with t as (select distinct conv_id, turn, {'r': role, 't': text} as u from conversations),
c as (select conv_id, list(u order by turn, u.r, u.t) as all_turns, count(*) as n from t group by conv_id),
p as (select distinct all_turns[1:k] as pre from (select all_turns, unnest(range(1, n)) as k from c)),
m as (select min(conv_id) as conv_id, all_turns, any_value(n) as n_turns from c where all_turns not in (select pre from p) group by all_turns)
select m.conv_id, cast(floor(turn / 256) as bigint) as part, cast(n_turns as bigint) as n_turns,
  string_agg('<|im_start|>' || coalesce(t.u.r, '') || chr(10) || coalesce(t.u.t, '') || '<|im_end|>' || chr(10), '' order by turn, t.u.r, t.u.t) as text
from m join t on m.conv_id = t.conv_id group by 1, 2, 3
"""
