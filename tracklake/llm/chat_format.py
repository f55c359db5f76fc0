"""Chat formatting of logged conversations, DataFrame functions only.

A client that logs the whole conversation after each answer leaves a chain of snapshots, each a prefix
of the next. A rolling hash over (position, role, text) identifies every turn prefix; a conversation
whose own hash is a proper prefix of a longer one, or that repeats an equal one with a smaller id, is
taken out by anti-joins; what is left is rendered.

The rolling hash is a running XOR of position-keyed 128-bit turn hashes. A prefix that thousands of
conversations share is one row after the map-side part of the distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import external_id, has_columns, internal_id

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with its position in the conversation, the prefix hash up to it, and the length."""
    inside = Window.partitionBy("conv").orderBy("turn", "role", "text")
    turns = turns.withColumn("position", F.row_number().over(inside))
    keyed = ["position", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))]
    turns = turns.select("conv", "position", "role", "text", F.xxhash64(F.lit(1), *keyed).alias("a"), F.xxhash64(F.lit(2), *keyed, F.lit(7)).alias("b"))
    whole = Window.partitionBy("conv")
    so_far = whole.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.select(
        "conv", "position", "role", "text",
        F.bit_xor("a").over(so_far).alias("a"), F.bit_xor("b").over(so_far).alias("b"),
        F.count(F.lit(1)).over(whole).alias("turns"),
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_logged, rendered.

    Turns are taken in the order of (turn, role, text), so ties and repeated rows have one order, and
    every row counts as a turn. Null role or text is empty; a null turn comes first; rows with a null
    conv_id form one conversation whose id is null and which counts as the smallest. n_logged is the
    number of equal conversations, of which the one with the smallest id is rendered. An empty table
    gives no rows; other columns are ignored, whatever their names. Texts of any length are taken whole.
    """
    has_columns(conversations, "conv_id", "turn", "role", "text")
    prefixes = _prefixes(conversations.select(internal_id("conv_id").alias("conv"), "turn", "role", "text"))
    whole = prefixes.where("position = turns").groupBy("turns", "a", "b").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_logged"))
    within = prefixes.where("position < turns").select(F.col("position").cast("long").alias("turns"), "a", "b").distinct()
    kept = whole.join(within, ["turns", "a", "b"], "left_anti").select("conv", "n_logged")
    turn = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    shown = prefixes.join(kept, "conv").groupBy("conv", "n_logged").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(F.struct("position", turn.alias("shown")))).alias("shown")
    )
    rendered = F.concat_ws("\n", F.transform("shown", lambda x: x["shown"]))
    return shown.select(external_id(F.col("conv")).alias("conv_id"), "n_turns", "n_logged", rendered.alias("rendered"))


ORACLE = f"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as p,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations),
c as (
  select conv_id, count(*) as n_turns,
         string_agg('{OPEN}' || role || chr(10) || text || '{CLOSE}', chr(10) order by p) as rendered
  from t group by conv_id),
p as (
  select distinct string_agg('{OPEN}' || role || chr(10) || text || '{CLOSE}', chr(10))
         over (partition by conv_id order by p rows between unbounded preceding and current row) as rendered, p as n_turns, conv_id
  from t),
proper as (select distinct p.n_turns, p.rendered from p join c using (conv_id) where p.n_turns < c.n_turns)
select min(conv_id) as conv_id, n_turns, count(*) as n_logged, rendered
from c where not exists (select 1 from proper q where q.n_turns = c.n_turns and q.rendered = c.rendered)
group by n_turns, rendered
"""
