"""Conversations in reply order without quotations (operator 4, SQL functions only).

A line that starts with `>` marks is quoted at the level of their number. Neighbouring lines of one level are a passage. A
passage is matched whole, by paragraph and by line; each unit is normalised (lower case, single spaces) and hashed. The
units of a message's own words (whole, paragraphs, lines) are the originals. A unit is linked to the latest earlier message
of its conversation that says it in its own words; a message replies to the original of the longest unit among its
outermost quotes (ties: the later message). Deeper quotes are linked in the same way and counted.

Linking is an as-of lookup: originals and quotes of one (conversation, hash) are ordered by turn and the last original
before a quote is carried forward. No pairs of messages are made, and a phrase that everybody says costs a row each.

A conversation is put in reply order by (turn of the thread's first message, depth of the reply, turn), so every message
follows the one it replies to. Roots and depths are found by doubling the known steps. A message that quotes nothing known
starts a thread. Positions come from a distributed rank, so a conversation of any length is not held in one task.

Defined cases: a null text is an empty message; a null turn comes first in its conversation, quotes nothing and is not
quoted; a null conversation is one of its own, without links. Repeated rows keep a position each. Text that is only
quotation leaves an empty body. An empty table gives no rows; clashing names of added columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ranking import rank_in_group
from .tables import stored

_ADDED = ("body", "n_passages", "n_linked", "max_level", "parent_turn", "root_turn", "depth", "position")
_MARKS = r"^([ \t]*>)+"


def lines_of(text: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def unquoted(line: Column) -> Column:
    return F.regexp_replace(line, _MARKS + r"[ \t]?", "")


def own_words(text: Column) -> Column:
    """The lines that are not quoted; blank lines left by a quote at either end go."""
    kept = F.array_join(F.filter(lines_of(text), lambda x: level_of(x) == 0), "\n")
    return F.when(F.instr(F.coalesce(text, F.lit("")), ">") == 0, F.coalesce(text, F.lit(""))).otherwise(F.regexp_replace(kept, r"^\s+|\s+$", ""))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _units(text: Column) -> Column:
    """Distinct normalised units of a passage: whole, paragraphs, lines."""
    units = F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, "\n"))
    return F.array_distinct(F.filter(F.transform(units, _normal), lambda x: x != ""))


def _passages(quoting: DataFrame) -> DataFrame:
    """(_row, conv_id, turn, level, run, passage) of messages that quote."""
    lines = quoting.select("_row", "conv_id", "turn", F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    lines = lines.withColumn("level", level_of(F.col("line")))
    run = F.col("at") - F.row_number().over(Window.partitionBy("_row", "level").orderBy("at"))
    runs = lines.withColumn("run", run).filter("level > 0").groupBy("_row", "conv_id", "turn", "level", "run")
    ordered = F.array_sort(F.collect_list(F.struct("at", unquoted(F.col("line")).alias("line"))))
    return runs.agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("passage"))


def quote_links(messages: DataFrame) -> DataFrame:
    """(_row, n_passages, n_linked, max_level, parent_turn) of messages (_row, conv_id, turn, text) that quote."""
    quoting = messages.filter(F.regexp_like("text", F.lit(r"(?m)^[ \t]*>")))
    passages = stored(_passages(quoting), "passages")
    units = passages.select("_row", "conv_id", "turn", "level", "run", F.explode(_units(F.col("passage"))).alias("unit"))
    units = units.select("_row", "conv_id", "turn", "level", "run", F.xxhash64("unit").alias("h"), F.length("unit").alias("size"))
    threads = passages.select("conv_id").distinct()
    originals = messages.join(threads, "conv_id", "left_semi").filter("turn IS NOT NULL")
    originals = originals.select("conv_id", "turn", F.explode(_units(own_words(F.col("text")))).alias("unit")).select("conv_id", "turn", F.xxhash64("unit").alias("h")).distinct()
    both = originals.select("conv_id", "turn", "h", F.col("turn").alias("said"), *[F.lit(None).cast(t).alias(c) for c, t in (("_row", "long"), ("level", "int"), ("run", "int"), ("size", "int"))])
    both = both.unionByName(units.filter("turn IS NOT NULL").withColumn("said", F.lit(None).cast("long")))
    earlier = Window.partitionBy("conv_id", "h").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("original", F.max("said").over(earlier)).filter("_row IS NOT NULL AND original IS NOT NULL")
    linked = found.groupBy("_row").agg(
        F.count_distinct("level", "run").alias("n_linked"), F.min_by(F.struct("level", "size", "original"), F.struct("level", -F.col("size"), -F.col("original"))).alias("best")
    )
    counted = passages.groupBy("_row").agg(F.count(F.lit(1)).alias("n_passages"), F.max("level").alias("max_level"))
    return counted.join(linked, "_row", "left").select("_row", "n_passages", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "max_level", F.col("best.original").alias("parent_turn"))


def _threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of turns that reply to an earlier one, by doubling the steps known."""
    known = stored(replies.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth")), "threads")
    while True:
        above = known.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root_turn").alias("r"), F.col("depth").alias("d"))
        longer = known.join(above, (F.col("conv_id") == F.col("c")) & (F.col("root_turn") == F.col("t")), "left")
        known = stored(longer.select("conv_id", "turn", F.coalesce("r", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"), F.col("r").isNotNull().alias("moved")), "threads")
        moved = known.filter("moved").limit(1).count()
        known = known.drop("moved")
        if not moved:
            return known


def format_conversations(messages: DataFrame) -> DataFrame:
    """`messages` (conv_id, turn, role, text) with body, n_passages, n_linked, max_level, parent_turn, root_turn, depth and
    position (from 1 within the conversation)."""
    rows = stored(messages.drop(*_ADDED, "_row").withColumn("_row", F.monotonically_increasing_id()), "messages")
    keyed = rows.select("_row", F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("text").cast("string"))
    links = stored(quote_links(keyed), "links")
    replies = links.filter("parent_turn IS NOT NULL").join(keyed.select("_row", "conv_id", "turn"), "_row").groupBy("conv_id", "turn").agg(F.max("parent_turn").alias("parent_turn"))
    threads = _threads(replies)
    turn = F.coalesce(F.col("turn"), F.lit(-1 << 62)).cast("long")
    placed = keyed.select("_row", "conv_id", "turn").join(threads, ["conv_id", "turn"], "left").select(
        "_row", "conv_id", F.coalesce("root_turn", turn).alias("_root"), F.coalesce("depth", F.lit(0)).alias("depth"), turn.alias("_turn"))
    ranked = rank_in_group(placed, ["conv_id"], [("_root", True), ("depth", True), ("_turn", True)], "_row", "position")
    out = rows.join(links, "_row", "left").join(ranked.select("_row", F.when(F.col("_root") > F.lit(-1 << 62), F.col("_root")).alias("root_turn"), "depth", "position"), "_row")
    return out.withColumn("body", own_words(F.col("text").cast("string"))).select(
        *[F.col(f"`{c}`") for c in messages.columns if c not in _ADDED and c != "_row"], "body", F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("max_level", F.lit(0)).alias("max_level"), "parent_turn", "root_turn", "depth", "position",
    )
