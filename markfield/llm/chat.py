"""Chat formatting in budgeted windows, with built-in functions only.

Turns are marked by a template; control strings inside texts are escaped so that they can be read back. Prefix
sums of turn costs cut a conversation into turn-aligned spans: the turns of a span lie within one stretch of the
budget that the system turn and the history leave; a turn across the end of a stretch is a span of its own. Every
window holds the system turn (if it came before), the turns of at most ``history`` cost before its span, and
its span. The cost of a turn is that of its formatted text, template and escapes included. Loss covers the assistant turns of the span; repeated turns are masked, so every assistant text is a
target once.

Prefix sums are made in blocks of turn numbers and history is found by an equality join on stretches, so a very long
conversation is spread over tasks; a window is bounded by the budget, except for a single longer turn.

Null text is empty, a null role an empty role, a null turn comes first; turns of equal number are ordered by role and
text; repeated rows are turns of their own; a null conversation id is one conversation. Extra columns are ignored; an
empty table gives no windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markfield.llm.common import settle, table

# Turn markers of the template, and the control strings of common templates that are escaped in texts.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = r"([<\[])(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"
#: A turn read back: the role ends at the first line feed without a backslash.
TURN = r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n(.*)$"
BUDGET, HISTORY = 1024, 256
BLOCK = 4096


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put behind the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1\\\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def piece_head(role: Column) -> Column:
    return F.concat(F.lit(START), F.replace(escaped(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))


def most_tokens(piece: Column) -> Column:
    """Tokens a formatted turn can have at most in any byte-level vocabulary: every token has a byte of its own.

    A window within a budget of this cost is within it for every such vocabulary; a caller who knows one passes a
    closer cost that no turn exceeds.
    """
    return F.octet_length(piece)


def turns(rows: DataFrame, cost: Callable[[Column], Column] = most_tokens, block: int = BLOCK) -> DataFrame:
    """``conv, pos, role, text, cost, before``: turns numbered from 0, and the cost of those before, per conversation."""
    plain = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = plain.withColumn("cost", cost(F.concat(piece_head(F.col("role")), escaped(F.col("text")), F.lit(END))).cast("long")).withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))).cast("long"))
    here = W.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    sums = plain.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("c"))
    over = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"),
                        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n0"),
                        F.coalesce(F.sum("c").over(over), F.lit(0)).alias("c0"))
    ranked = plain.withColumn("n1", F.count(F.lit(1)).over(here) - 1).withColumn("c1", F.sum("cost").over(here) - F.col("cost"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return ranked.join(bases, same).select("conv", (F.col("n0") + F.col("n1")).alias("pos"), "role", "text", "cost",
                                           (F.col("c0") + F.col("c1")).alias("before"))


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            cost: Callable[[Column], Column] = most_tokens) -> DataFrame:
    """``conv, window, first, last, repeated, cost, text, targets``: formatted windows in order per conversation.

    ``first`` and ``last`` number the turns of the span, ``repeated`` counts the turns before it in the window, and
    ``targets`` holds start and length of every text under the loss mask, in characters of ``text``.
    """
    numbered = settle(turns(rows, cost), "turns")
    system = numbered.filter(F.col("role") == "system").groupBy("conv").agg(
        F.min(F.struct("pos", "cost", "text")).alias("sys")).withColumnRenamed("conv", "_conv")
    placed = numbered.join(system, F.col("conv").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    is_system = F.coalesce(F.col("pos") == F.col("sys.pos"), F.lit(False))
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce(F.col("sys.cost"), F.lit(0)))
    lead = F.col("before") - F.when(F.col("pos") > F.col("sys.pos"), F.col("sys.cost")).otherwise(0)
    placed = placed.withColumn("at", lead).withColumn("size", F.when(is_system, 0).otherwise(F.col("cost")))
    across = (F.col("at") % room + F.col("size") > room).cast("long")
    placed = settle(placed.withColumn("window", 2 * F.floor(F.col("at") / room) + across), "spans")

    spans = placed.groupBy("conv", "window").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.min("at").alias("from"),
                                                 F.min("sys").alias("sys"))
    own = placed.select("conv", "window", "pos", "role", "text", "cost", F.lit(False).alias("again"))
    back = spans.select(F.col("conv").alias("_conv"), "window", "from", "first",
                        F.floor(F.col("from") / history).alias("_stretch"))
    end = F.col("at") + F.col("size")
    told = placed.filter((F.col("size") <= history) & ~is_system).drop("window").withColumn(
        "stretch", F.explode(F.sequence(F.floor(end / history), F.floor((F.col("at") + history) / history))))
    near = (F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
            & (end <= F.col("from")) & (F.col("from") <= F.col("at") + history) & (F.col("pos") < F.col("first")))
    repeated = told.join(back, near).select("conv", "window", "pos", "role", "text", "cost", F.lit(True).alias("again"))
    kept = spans.filter(F.col("sys.pos") < F.col("first")).select(
        "conv", "window", F.col("sys.pos").alias("pos"), F.lit("system").alias("role"), F.col("sys.text").alias("text"),
        F.col("sys.cost").alias("cost"), F.lit(True).alias("again"))

    whole = own.unionByName(repeated).unionByName(kept)
    whole = whole.withColumn("head", piece_head(F.col("role"))).withColumn("body", escaped(F.col("text")))
    piece = F.concat("head", "body", F.lit(END))
    inside = W.partitionBy("conv", "window").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = whole.withColumn("piece", piece).withColumn("till", F.sum(F.length("piece")).over(inside))
    start = F.col("till") - F.length(F.lit(END)) - F.length("body")
    target = F.when((F.col("role") == "assistant") & ~F.col("again"),
                    F.struct(start.alias("start"), F.length("body").cast("long").alias("length")))
    grouped = whole.groupBy("conv", "window").agg(
        F.min(F.when(~F.col("again"), F.col("pos"))).alias("first"), F.max("pos").alias("last"),
        F.sum(F.col("again").cast("int")).alias("repeated"), F.sum("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(target)).alias("targets"))
    return grouped.select("conv", "window", "first", "last", "repeated", "cost",
                          F.array_join(F.transform("pieces", lambda part: part["piece"]), "").alias("text"), "targets")


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv, n_turns, turns, loss, formatted_chars`` from formatted windows: every turn once, in order.

    ``turns`` is role, line feed, text, line feed of each turn; ``loss`` the text under the mask.
    """
    pieces = F.slice(F.split("text", r"<\|im_end\|>\n", -1), F.col("repeated") + 1, F.col("last") - F.col("first") + 1)
    turn = F.transform(pieces, lambda piece: F.concat(
        unescaped(F.regexp_extract(piece, TURN, 1)), F.lit("\n"), unescaped(F.regexp_extract(piece, TURN, 2)), F.lit("\n")))
    loss = F.transform("targets", lambda span: unescaped(F.col("text").substr(
        (span["start"] + 1).cast("int"), span["length"].cast("int"))))
    read = formatted.select("conv", "window", F.size(pieces).alias("n"), F.array_join(turn, "").alias("turns"),
                            F.array_join(loss, "").alias("loss"), F.length("text").alias("chars"))
    joined = lambda name: F.array_join(F.transform("parts", lambda part: part[name]), "").alias(name)
    return read.groupBy("conv").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts")).select(
        "conv", "n_turns", joined("turns"), joined("loss"), "formatted_chars")


def digests(formatted: DataFrame) -> DataFrame:
    return read_back(formatted).select(
        F.col("conv").alias("conv_id"), "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose two texts consist of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    return rows.unionByName(probe)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(windows(given(spark, sf_dir)))


SQL = rf"""
WITH given AS (
  SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
  SELECT *, row_number() OVER o - 1 AS pos, sum(cost) OVER o - cost AS before FROM (
    SELECT *, CAST(strlen(regexp_replace(replace(text, '\', '\\'), '{CONTROL}', '\1\\\2', 'g')) + strlen(role) AS BIGINT) + {len(START) + 1 + len(END)} AS cost,
      length(regexp_replace(replace(text, '\', '\\'), '{CONTROL}', '\1\\\2', 'g')) + length(role) + {len(START) + 1 + len(END)} AS chars
    FROM given)
  WINDOW o AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
system AS (
  SELECT conv, min(pos) AS pos, arg_min(cost, pos) AS cost, arg_min(chars, pos) AS chars
  FROM numbered WHERE role = 'system' GROUP BY conv),
placed AS (
  SELECT n.*, s.pos AS sys_pos, s.chars AS sys_chars, greatest(1, {BUDGET - HISTORY} - coalesce(s.cost, 0)) AS room,
    before - CASE WHEN n.pos > s.pos THEN s.cost ELSE 0 END AS place,
    CASE WHEN n.pos = s.pos THEN 0 ELSE n.cost END AS size
  FROM numbered n LEFT JOIN system s ON n.conv = s.conv),
spanned AS (SELECT *, 2 * (place // room) + CASE WHEN place % room + size > room THEN 1 ELSE 0 END AS win FROM placed),
spans AS (SELECT conv, win, min(pos) AS first, min(place) AS start, min(sys_pos) AS sys_pos, min(sys_chars) AS sys_chars
          FROM spanned GROUP BY conv, win),
extra AS (
  SELECT s.conv, sum(p.chars) AS chars FROM spans s JOIN spanned p ON p.conv = s.conv AND p.pos < s.first
    AND p.place + p.size <= s.start AND s.start <= p.place + {HISTORY} AND p.size <= {HISTORY} AND (p.sys_pos IS NULL OR p.pos <> p.sys_pos)
  GROUP BY s.conv),
kept AS (SELECT conv, sum(sys_chars) AS chars FROM spans WHERE sys_pos < first GROUP BY conv)
SELECT g.conv AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(g.chars) + coalesce(any_value(e.chars), 0) + coalesce(any_value(k.chars), 0) AS BIGINT) AS formatted_chars
FROM numbered g LEFT JOIN extra e ON g.conv = e.conv LEFT JOIN kept k ON g.conv = k.conv
GROUP BY g.conv
"""
