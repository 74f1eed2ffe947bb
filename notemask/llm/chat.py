"""Preference formatting: chosen and rejected conversations become a prompt and two completions with loss spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: How a turn is rendered, and whose turns are learnt.
OPEN, CLOSE = "<|", "|>"
END = "<|end|>\n"
LEARNT = "assistant"


def _content(text: Column) -> Column:
    """Null counts as empty; a turn's own text can't open a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |"))


def _role(role: Column) -> Column:
    return F.regexp_replace(F.coalesce(role, F.lit("unknown")), r"[^\w-]", "_")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _role(turn["role"]), F.lit(CLOSE + "\n"))


def _tail(turn: Column) -> Column:
    return F.concat(_content(turn["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    """The turns as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _tail(t))), "")


def loss_spans(turns: Column) -> Column:
    """`start:end` in code points, comma-joined, of what is learnt: content and end marker of the assistant's turns."""
    parts = F.transform(
        turns,
        lambda t: F.struct(
            F.char_length(_head(t)).alias("head"), F.char_length(_tail(t)).alias("tail"),
            (F.coalesce(t["role"], F.lit("")) == LEARNT).alias("learnt"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["head"]
        end = begin + p["tail"]
        span = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            end.alias("at"),
            F.when(p["learnt"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(parts, start, step, lambda acc: F.array_join(acc["spans"], ","))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Turns of the longest common prefix; turns are the same if role and text are, null being equal to null."""
    same = F.zip_with(chosen, rejected, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    shorter = F.least(F.size(chosen), F.size(rejected))
    first = F.array_position(F.slice(same, F.lit(1), shorter), False)
    return F.when(first == 0, shorter).otherwise(first - 1).cast("int")


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds n_common, prompt, chosen_text, rejected_text, chosen_loss, rejected_loss to rows with two arrays of turns.

    A turn is a struct with role and text. The common prefix is rendered once as prompt; each completion holds the
    turns behind it. Loss spans count from the start of their completion; all else is masked. If the conversations
    are equal or one is a prefix of the other, the completion that has no turns left is empty, with no loss. A null
    array counts as a conversation without turns.
    """
    none = F.array().cast(pairs.schema[chosen].dataType)
    a, b = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none.cast(pairs.schema[rejected].dataType))
    made = ["n_common", "prompt", "chosen_text", "rejected_text", "chosen_loss", "rejected_loss"]
    given = [F.col(f"`{c}`") for c in pairs.columns if c not in made]
    rows = pairs.select(F.struct(*given).alias("row"), a.alias("a"), b.alias("b"))  # other columns may have any names
    rows = rows.withColumn("n_common", common_turns(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(F.col(c), F.col("n_common") + 1, F.size(c))
    rows = rows.withColumns({"head": F.slice("a", F.lit(1), F.col("n_common")), "a": rest("a"), "b": rest("b")})
    columns = {
        "prompt": rendered(F.col("head")),
        "chosen_text": rendered(F.col("a")), "rejected_text": rendered(F.col("b")),
        "chosen_loss": loss_spans(F.col("a")), "rejected_loss": loss_spans(F.col("b")),
    }
    return rows.select("row.*", "n_common", *(c.alias(name) for name, c in columns.items()))


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """conv_id, chosen, rejected: each conversation up to its last reply, and the same with another's reply instead.

    The other conversation is the neighbour in its pair of ids (2k and 2k+1), so pairs form within one aggregation by
    k: no join, and no group larger than two conversations. A conversation without a reply stays whole on both sides;
    where the neighbour is missing or has no reply, the rejected side ends before the reply. Turns are ordered by
    turn, then role, then text; repeated rows are turns of their own. Rows without conv_id belong to no conversation.
    """
    turn = F.struct("turn", "role", "text")
    grouped = (
        conversations.filter("conv_id is not null")
        .groupBy(F.shiftright("conv_id", 1).alias("pair"))
        .agg(
            *(
                F.sort_array(F.collect_list(F.when(F.col("conv_id").bitwiseAND(F.lit(1)) == side, turn))).alias(f"turns{side}")
                for side in (0, 1)
            )
        )
    )

    def last_reply(turns: Column) -> Column:
        at = F.transform(turns, lambda t, i: F.when(t["role"] == LEARNT, i + 1).otherwise(0))
        return F.coalesce(F.array_max(at), F.lit(0))

    grouped = grouped.withColumns({f"at{s}": last_reply(F.col(f"turns{s}")) for s in (0, 1)})

    def side(s: int) -> Column:
        own, at, other, reply = F.col(f"turns{s}"), F.col(f"at{s}"), F.col(f"turns{1 - s}"), F.col(f"at{1 - s}")
        before = F.slice(own, F.lit(1), F.greatest(at - 1, F.lit(0)))
        swapped = F.concat(before, F.when(reply > 0, F.slice(other, F.greatest(reply, F.lit(1)), F.lit(1))).otherwise(F.slice(own, 1, 0)))
        return F.struct(
            (F.shiftleft("pair", 1) + s).alias("conv_id"),
            F.when(at > 0, F.slice(own, F.lit(1), at)).otherwise(own).alias("chosen"),
            F.when(at > 0, swapped).otherwise(own).alias("rejected"),
        )

    return grouped.select(F.explode(F.array(side(0), side(1))).alias("p")).select("p.*").filter(F.size("chosen") > 0)


def op1(spark, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations, rendered."""
    pairs = preference_pairs(table(spark, sf_dir, "conversations"))
    return format_preferences(pairs).select(
        "conv_id", "n_common", "prompt", "chosen_text", "rejected_text", "chosen_loss", "rejected_loss"
    )


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r,
    '<|' || regexp_replace(coalesce(role, 'unknown'), '[^\w-]', '_', 'g') || '|>' || chr(10) AS head,
    replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS tail,
    role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, coalesce(max(i) FILTER (WHERE r = 'assistant'), 0) AS upto, max(i) AS n FROM t GROUP BY 1),
chosen AS (
  SELECT t.* FROM t JOIN last USING (conv_id) WHERE upto = 0 OR i <= upto),
rejected AS (
  SELECT t.conv_id, t.r, t.head, t.tail, t.role, t.text, t.i FROM t JOIN last USING (conv_id) WHERE upto = 0 OR i < upto
  UNION ALL
  SELECT a.conv_id, t.r, t.head, t.tail, t.role, t.text, a.upto
  FROM last a JOIN last b ON b.conv_id = xor(a.conv_id, 1) AND b.upto > 0
  JOIN t ON t.conv_id = b.conv_id AND t.i = b.upto WHERE a.upto > 0),
common AS (
  SELECT l.conv_id,
    coalesce(min(coalesce(c.i, j.i)) FILTER (WHERE c.i IS NULL OR j.i IS NULL
      OR c.role IS DISTINCT FROM j.role OR c.text IS DISTINCT FROM j.text) - 1,
      max(c.i)) AS n_common
  FROM last l JOIN (
    SELECT conv_id, i FROM chosen UNION SELECT conv_id, i FROM rejected) u USING (conv_id)
  LEFT JOIN chosen c ON c.conv_id = u.conv_id AND c.i = u.i
  LEFT JOIN rejected j ON j.conv_id = u.conv_id AND j.i = u.i
  GROUP BY 1),
ends AS (
  SELECT 'c' AS side, conv_id, i, r, head, tail FROM chosen
  UNION ALL SELECT 'r', conv_id, i, r, head, tail FROM rejected),
placed AS (
  SELECT e.*, n_common,
    sum(length(head) + length(tail)) OVER (PARTITION BY side, conv_id, i > n_common ORDER BY i) AS stop
  FROM ends e JOIN common USING (conv_id)),
parts AS (
  SELECT conv_id, any_value(n_common) AS n_common,
    coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (WHERE side = 'c' AND i <= n_common), '') AS prompt,
    coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (WHERE side = 'c' AND i > n_common), '') AS chosen_text,
    coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (WHERE side = 'r' AND i > n_common), '') AS rejected_text,
    coalesce(string_agg((stop - length(tail))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY i)
      FILTER (WHERE side = 'c' AND i > n_common AND r = 'assistant'), '') AS chosen_loss,
    coalesce(string_agg((stop - length(tail))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY i)
      FILTER (WHERE side = 'r' AND i > n_common AND r = 'assistant'), '') AS rejected_loss
  FROM placed GROUP BY 1)
SELECT conv_id, n_common::INTEGER AS n_common, prompt, chosen_text, rejected_text, chosen_loss, rejected_loss FROM parts
"""
