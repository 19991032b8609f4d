"""Preference formatting of paired conversations.

The chosen and the rejected conversation of a pair share their longest common prefix of turns.
It is rendered once, as the prompt; what follows is rendered as two completions. Each segment
carries a mask: the character ranges, within the segment, of assistant turns of a completion,
over which a loss is to be taken. A prompt has none.

A conversation may hold any number of turns, so its text is not gathered in one row: turns are
rendered in segments of ``SEGMENT`` turn numbers, in order of ``segment``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers in one rendered segment.
SEGMENT = 64
#: Which reply a rejected conversation changes, and whose text it gets.
SWAPPED = (("first", "last"), ("middle", "first"), ("last", "first"))


def render(role: Column, text: Column) -> Column:
    """A turn as marked-up text."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def _turns(turns: DataFrame, pair_id: str, side: str) -> DataFrame:
    known = F.coalesce
    return turns.filter(F.col(pair_id).isNotNull() & F.col("turn").isNotNull()).select(
        F.col(pair_id).alias("pair_id"), F.col("turn").cast("long").alias("turn"), F.lit(side).alias("side"),
        F.struct(known("role", F.lit("user")).alias("role"), known("text", F.lit("")).alias("text")).alias("said"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair_id: str = "pair_id") -> DataFrame:
    """Segments (pair_id, part, segment, text, mask, turns) of each pair.

    Both inputs hold (pair id, turn, role, text); other columns are ignored. ``part`` is prompt,
    chosen or rejected; ``mask`` is array<struct<start, end>> of character ranges; ``turns`` counts
    the segment's turns. Turns go by their number, gaps allowed. If a conversation has a turn
    number twice, the least (role, text) counts. Rows without pair or turn are left out; a null
    role is a user's, a null text is empty. A conversation whose partner is missing is all
    completion, beside an empty one; a completion without turns has no segment.
    """
    both = _turns(chosen, pair_id, "chosen").unionByName(_turns(rejected, pair_id, "rejected"))
    least = {s: F.min(F.when(F.col("side") == s, F.col("said"))).alias(s) for s in ("chosen", "rejected")}
    turns = both.groupBy("pair_id", "turn").agg(*least.values())
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    splits = turns.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("split"))
    common = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    sides = F.when(common, F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("said")))).otherwise(
        F.array(*[F.struct(F.lit(s).alias("part"), F.col(s).alias("said")) for s in ("chosen", "rejected")]))
    said = (turns.join(splits, "pair_id").select("pair_id", "turn", F.explode(sides).alias("x"))
            .filter(F.col("x.said").isNotNull())
            .select("pair_id", F.col("x.part").alias("part"), F.floor(F.col("turn") / SEGMENT).alias("segment"), "turn",
                    F.col("x.said.role").alias("role"), render(F.col("x.said.role"), F.col("x.said.text")).alias("text")))
    whole = said.groupBy("pair_id", "part", "segment").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
    # Running ends of the rendered turns, from which the masked ranges follow.
    ends = F.expr("transform(rows, (r, i) -> aggregate(slice(rows, 1, i + 1), 0, (n, x) -> n + length(x.text)))")
    ranges = F.expr(
        "transform(filter(arrays_zip(rows, ends), z -> part <> 'prompt' and z.rows.role = 'assistant'), "
        "z -> named_struct('start', z.ends - length(z.rows.text), 'end', z.ends))")
    return whole.withColumn("ends", ends).select(
        "pair_id", "part", "segment", F.array_join(F.transform("rows", lambda r: r["text"]), "").alias("text"),
        ranges.alias("mask"), F.size("rows").alias("turns"))


def reply_swaps(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs made from single conversations: (chosen, rejected), each with pair_id.

    The chosen one is the whole conversation. In the rejected one a reply of the assistant says what
    another one of it says, an answer to another question: the first reply what the last says, or
    the middle or the last what the first says, by the remainder of conv_id and three. All other turns
    are the same, so the sides part at that reply and go on to the end, whatever turn that is. The
    middle reply is the first one not before the midpoint of first and last.

    A conversation with a single reply has no other answer: its rejected side ends before the reply.
    One without any makes no pair, nor does a null conv_id. Of repeated turns all replies are swapped,
    for the least or, as last, the greatest text of theirs.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    replies = rows.filter("role = 'assistant' AND turn IS NOT NULL").select("pair_id", F.struct("turn", "text").alias("said"))
    spans = replies.groupBy("pair_id").agg(F.min("said").alias("first"), F.max("said").alias("last"))
    later = replies.join(spans, "pair_id").filter(2 * F.col("said.turn") >= F.col("first.turn") + F.col("last.turn"))
    picks = spans.join(later.groupBy("pair_id").agg(F.min("said").alias("middle")), "pair_id").withColumn(
        "which", F.pmod(F.col("pair_id").cast("long"), F.lit(len(SWAPPED)))).select(
        "pair_id", F.element_at(F.array(*[F.col(a)["turn"] for a, _ in SWAPPED]), (F.col("which") + 1).cast("int")).alias("swap"),
        F.element_at(F.array(*[F.col(b)["text"] for _, b in SWAPPED]), (F.col("which") + 1).cast("int")).alias("other"),
        (F.col("first.turn") == F.col("last.turn")).alias("alone"))
    joined = rows.join(picks, "pair_id")
    names = ["pair_id", "turn", "role", "text"]
    swapped = (F.col("turn") == F.col("swap")) & (F.col("role") == "assistant")
    rejected = joined.filter(~F.coalesce(F.col("alone") & (F.col("turn") >= F.col("swap")), F.lit(False))).withColumn(
        "text", F.when(swapped, F.col("other")).otherwise(F.col("text")))
    return joined.select(*names), rejected.select(*names)


def oracle_sql() -> str:
    """DuckDB SQL of the preference segments of ``reply_swaps`` over ``conversations``, without repeated turns."""
    return f"""
WITH replies AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'
), spans AS (
  SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn FROM replies GROUP BY 1
), middles AS (
  SELECT conv_id, min(turn) AS middle_turn FROM replies JOIN spans USING (conv_id)
  WHERE 2 * turn >= first_turn + last_turn GROUP BY 1
), picks AS (
  SELECT conv_id, first_turn = last_turn AS alone,
         CASE conv_id % 3 WHEN 0 THEN first_turn WHEN 1 THEN middle_turn ELSE last_turn END AS swap_turn,
         CASE conv_id % 3 WHEN 0 THEN last_turn ELSE first_turn END AS other_turn
  FROM spans JOIN middles USING (conv_id)
), chosen AS (
  SELECT c.conv_id, c.turn, c.role, c.text, p.alone, p.swap_turn, p.other_turn FROM conversations c JOIN picks p USING (conv_id)
), rejected AS (
  SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn = c.swap_turn THEN r.text ELSE c.text END AS text
  FROM chosen c JOIN replies r ON r.conv_id = c.conv_id AND r.turn = c.other_turn
  WHERE NOT (c.alone AND c.turn >= c.swap_turn)
), split AS (
  SELECT c.conv_id, min(c.turn) AS split FROM chosen c
  LEFT JOIN rejected r ON r.conv_id = c.conv_id AND r.turn = c.turn AND r.role = c.role AND r.text = c.text
  WHERE r.conv_id IS NULL GROUP BY 1
), parts AS (
  SELECT conv_id, CASE WHEN split IS NULL OR turn < split THEN 'prompt' ELSE 'chosen' END AS part, turn, role, text
  FROM chosen LEFT JOIN split USING (conv_id)
  UNION ALL
  SELECT conv_id, 'rejected', turn, role, text FROM rejected JOIN split USING (conv_id) WHERE turn >= split
), shown AS (
  SELECT conv_id, part, turn // {SEGMENT} AS segment, turn, role,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS text FROM parts
), placed AS (
  SELECT *, sum(length(text)) OVER (PARTITION BY conv_id, part, segment ORDER BY turn) AS stop FROM shown
)
SELECT conv_id, part, CAST(segment AS BIGINT) AS segment, string_agg(text, '' ORDER BY turn) AS text,
       coalesce(string_agg(CASE WHEN part <> 'prompt' AND role = 'assistant'
                                THEN (stop - length(text)) || '-' || stop END, ',' ORDER BY turn), '') AS mask,
       count(*) AS turns
FROM placed GROUP BY 1, 2, 3
"""
