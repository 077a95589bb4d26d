"""Duplicate detection within an issue and against the previous days.

Conflicts are reported per group pair, not per item pair: n items sharing a link on one date are one
cell, so a link copied a million times gives one row per pair of dates and the number of item pairs
behind it. `url_conflicts_by_item` gives each item its own count and detail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ranking import rank_in_group
from .similarity import HOT_TOKEN, distinct_sets, set_members, similar_sets


def _in_reach(newer: str, older: str, days: int):
    gap = F.date_diff(newer, older)
    return (gap >= 0) & (gap <= days)


def _reachable(cells: DataFrame, days: int, out: str, date: str = "issue_date") -> DataFrame:
    """Every cell once for each date that can meet it, in `out`: its own and the `days` after it. Dates then are join keys."""
    return cells.withColumn(out, F.explode(F.sequence(F.col(date), F.date_add(F.col(date), days))))


def _follow_up_pairs(keyed: DataFrame, follow_ups: DataFrame, cell: list[str], days: int) -> DataFrame:
    """Pairs that are exempt because the newer item says it follows up the older one: id, other_id and
    the cells of both. At most one row per follow-up and cell."""
    mine = follow_ups.join(keyed, "id")
    other = keyed.select(
        F.col("id").alias("follow_up_of"), F.col("issue_date").alias("other_date"), *[F.col(c).alias(f"other_{c}") for c in cell]
    )
    older = (F.col("other_date") < F.col("issue_date")) | (F.col("follow_up_of") < F.col("id"))
    return mine.join(other, "follow_up_of").filter(_in_reach("issue_date", "other_date", days) & older)


def exempt_pairs(item_urls: DataFrame, follow_ups: DataFrame, days: int = 7, newer: DataFrame | None = None) -> DataFrame:
    """Follow-ups and the item they follow that share a link, one row per shared link. The link is part of the join key, so
    an item with very many links makes no more rows than it shares. `newer`: the rows of `item_urls` that can have a pair, if known."""
    mine = follow_ups.join(item_urls if newer is None else newer, "id")
    other = item_urls.select(F.col("id").alias("follow_up_of"), F.col("issue_date").alias("other_date"), "url")
    older = (F.col("other_date") < F.col("issue_date")) | (F.col("follow_up_of") < F.col("id"))
    return mine.join(other, ["follow_up_of", "url"]).filter(_in_reach("issue_date", "other_date", days) & older)


def url_conflicts(item_urls: DataFrame, follow_ups: DataFrame, days: int = 7) -> DataFrame:
    """(url, issue_date, other_date, n_pairs): item pairs sharing a canonical link, the other item being
    earlier in the issue (smaller id) or in the previous `days` days.

    item_urls: id, issue_date, url, distinct. follow_ups: id, follow_up_of."""
    cells = item_urls.filter("url is not null and issue_date is not null").groupBy("url", "issue_date").agg(F.count(F.lit(1)).alias("n"))
    # A link has one cell a date, so its window is bounded by the calendar and a frame by `days` + 1 cells: only pairs of cells
    # that do meet become rows.
    lately = Window.partitionBy("url").orderBy(F.unix_date("issue_date")).rangeBetween(-days, 0)
    met = F.collect_list(F.struct(F.col("issue_date").alias("other_date"), F.col("n").alias("m"))).over(lately)
    pairs = (
        cells.select("*", met.alias("met")).filter("n > 1 or size(met) > 1")
        .select("url", "issue_date", "n", F.inline("met"))
        .withColumn(
            "pairs",
            F.when(F.col("issue_date") == F.col("other_date"), F.expr("n * (n - 1) div 2")).otherwise(F.col("n") * F.col("m")),
        )
        .filter("pairs > 0")
    )
    exempt = (
        exempt_pairs(item_urls, follow_ups, days)
        .groupBy("url", "issue_date", "other_date").agg(F.count(F.lit(1)).alias("exempt"))
    )
    return (
        pairs.join(exempt, ["url", "issue_date", "other_date"], "left")
        .withColumn("n_pairs", F.col("pairs") - F.coalesce("exempt", F.lit(0)))
        .filter("n_pairs > 0")
        .select("url", "issue_date", "other_date", "n_pairs")
    )


def numbered_links(item_urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`item_urls` with a number in place of each link, and (url, link) with the links of the numbers. Numbers have the order of the
    links, so that what is moved and compared from here on is no text."""
    links = item_urls.filter("url is not null").select(F.col("url").alias("link")).distinct()
    names = stored(links.repartitionByRange("link").sortWithinPartitions("link").withColumn("url", F.monotonically_increasing_id()), "link_numbers")
    numbered = item_urls.withColumnRenamed("url", "link").join(names, "link").drop("link")
    return stored(numbered, "numbered_links"), names


def url_conflicts_by_item(item_urls: DataFrame, follow_ups: DataFrame, days: int = 7, parts: int | None = None) -> DataFrame:
    """(id, issue_date, n_conflicts, detail): how many earlier items share a link with the item, counted
    per link, and the smallest such link.

    Only items of cells (link, date) that meet an earlier item of their own or another cell are numbered and joined."""
    linked = item_urls.filter("url is not null and issue_date is not null").select("id", "issue_date", "url")
    cells = linked.groupBy("url", "issue_date").agg(F.count(F.lit(1)).alias("n"))
    lately = Window.partitionBy("url").orderBy(F.unix_date("issue_date")).rangeBetween(-days, -1)  # a row per date
    met = cells.select("*", F.coalesce(F.sum("n").over(lately), F.lit(0)).alias("earlier_days")).filter("n > 1 or earlier_days > 0")
    members = stored(linked.join(met, ["url", "issue_date"]), "met_links")
    exempt = (
        exempt_pairs(linked, follow_ups, days, members.select("id", "issue_date", "url"))
        .groupBy("id", "url").agg(F.count(F.lit(1)).alias("exempt"))
    )
    shared = rank_in_group(members.filter("n > 1"), ["url", "issue_date"], [], "id", "position", parts)
    counted = (
        members.filter("n = 1").withColumn("position", F.lit(1).cast("bigint")).unionByName(shared)
        .join(exempt, ["id", "url"], "left")
        .withColumn("k", F.col("position") - 1 + F.col("earlier_days") - F.coalesce("exempt", F.lit(0)))
    )
    return (
        counted.filter("k > 0").groupBy("id", "issue_date")
        .agg(F.sum("k").alias("n_conflicts"), F.min("url").alias("detail"))
    )


def duplicate_ids(items: DataFrame) -> DataFrame:
    """(issue_date, id, n_conflicts): an id used more than once in an issue, reported from the second on."""
    return (
        items.groupBy("issue_date", "id").agg((F.count(F.lit(1)) - 1).alias("n_conflicts")).filter("n_conflicts > 0")
    )


def _both_ways(sets: DataFrame, threshold: float, hot: int) -> DataFrame:
    """(set_a, set_b, jaccard) of similar sets in both directions, and of every set with itself."""
    pairs = similar_sets(sets, threshold, hot).select("set_a", "set_b", "jaccard")
    same = sets.select(F.col("set_id").alias("set_a"), F.col("set_id").alias("set_b"), F.lit(1.0).alias("jaccard"))
    return pairs.unionByName(pairs.select(F.col("set_b").alias("set_a"), F.col("set_a").alias("set_b"), "jaccard")).unionByName(same)


def _linked_pairs(keyed: DataFrame, item_urls: DataFrame, both: DataFrame, days: int) -> DataFrame:
    """Pairs of items with similar titles, a common entity and a common link, counted per pair of cells (columns of
    `title_conflicts`, `linked`).

    Items of one cell with the same links are one part of it; link sets are told by two 64-bit sums, never collected, and a
    part's links are those of its smallest item. Parts meet by link, similar title set and date; a pair of parts with several
    common links counts once."""
    hashes = [F.bit_xor(F.xxhash64("url", F.lit(k))).alias(f"h{k}") for k in (1, 2)]
    digests = item_urls.groupBy("id").agg(F.count(F.lit(1)).alias("h0"), *hashes)
    parts = keyed.join(digests, "id").groupBy("set_id", "entities", "issue_date", "h0", "h1", "h2").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("part"))
    parts = stored(parts.select("part", "set_id", "entities", "issue_date", "m"), "title_parts")
    by_link = item_urls.select(F.col("id").alias("part"), "url").join(parts, "part")
    side = lambda df, x: df.select("url", *[F.col(c).alias(f"{n}_{x}") for c, n in (("part", "part"), ("set_id", "set"), ("entities", "entities"), ("issue_date", "date"), ("m", "m"))])
    met = side(by_link, "a").join(both, "set_a").join(_reachable(side(by_link, "b"), days, "date_a", "date_b"), ["url", "set_b", "date_a"])
    same_day = F.col("date_a") == F.col("date_b")
    same_part = F.col("part_a") == F.col("part_b")
    sides = [F.struct(*[F.col(f"{c}_{x}").alias(c) for c in ("set", "entities", "part")]) for x in ("a", "b")]
    ordered = ~same_day | same_part | (sides[0] < sides[1])
    once = met.filter(ordered & F.arrays_overlap("entities_a", "entities_b")).dropDuplicates(["part_a", "part_b", "date_a", "date_b"])
    pairs = F.when(same_part, F.expr("m_a * (m_a - 1) div 2")).otherwise(F.col("m_a") * F.col("m_b"))
    return once.groupBy("set_a", "entities_a", "date_a", "set_b", "entities_b", "date_b").agg(F.sum(pairs).alias("linked"))


def title_conflicts(
    items: DataFrame, tokens, follow_ups: DataFrame, threshold: float = 0.5, days: int = 7, hot: int = HOT_TOKEN, item_urls: DataFrame | None = None
) -> DataFrame:
    """(set_a, date_a, set_b, date_b, entities, n_pairs, jaccard): pairs of similar titles that share an
    entity. Titles with the same token set, entities and date are one cell; set_a holds the newer items
    (the smaller set id on the same date). A cell is compared with itself when it has copies. With `item_urls` (id,
    issue_date, url, distinct), pairs with a common link are left out: those are reported by their link.

    items: id, issue_date, entities (canonical, lower case)."""
    sets = distinct_sets(items, "id", tokens)
    both = stored(_both_ways(sets, threshold, hot), "similar")
    keyed = set_members(items.withColumn("entities", F.array_sort("entities")), "id", tokens, sets).filter("set_id is not null")
    cells = keyed.groupBy("set_id", "issue_date", "entities").agg(F.count(F.lit(1)).alias("n"))
    newer = cells.select(
        F.col("set_id").alias("set_a"), F.col("issue_date").alias("date_a"), F.col("entities").alias("entities_a"), F.col("n").alias("n_a")
    )
    older = cells.select(
        F.col("set_id").alias("set_b"), F.col("issue_date").alias("date_b"), F.col("entities").alias("entities_b"), F.col("n").alias("n_b")
    )
    first = F.struct("set_a", "entities_a")
    second = F.struct(F.col("set_b").alias("set_a"), F.col("entities_b").alias("entities_a"))
    same_day = F.col("date_a") == F.col("date_b")
    met = (
        newer.join(both, "set_a").join(_reachable(older, days, "date_a", "date_b"), ["set_b", "date_a"])
        .filter((~same_day | (first <= second)) & F.arrays_overlap("entities_a", "entities_b"))
        .withColumn(
            "pairs", F.when(same_day & (first == second), F.expr("n_a * (n_a - 1) div 2")).otherwise(F.col("n_a") * F.col("n_b"))
        )
    )
    link = _follow_up_pairs(keyed.select("id", "issue_date", "set_id", "entities"), follow_ups, ["set_id", "entities"], days)
    if item_urls is not None:  # a follow-up with a common link is among the linked pairs already
        link = link.join(exempt_pairs(item_urls, follow_ups, days).select("id", "follow_up_of").distinct(), ["id", "follow_up_of"], "left_anti")
    own, their = F.struct("set_id", "entities"), F.struct(F.col("other_set_id").alias("set_id"), F.col("other_entities").alias("entities"))
    flip = (F.col("issue_date") == F.col("other_date")) & (own > their)
    exempt = (
        link.select(
            F.when(flip, their).otherwise(own).alias("x"), F.when(flip, own).otherwise(their).alias("y"),
            F.col("issue_date").alias("date_a"), F.col("other_date").alias("date_b"),
        )
        .groupBy(
            F.col("x.set_id").alias("set_a"), F.col("x.entities").alias("entities_a"), "date_a",
            F.col("y.set_id").alias("set_b"), F.col("y.entities").alias("entities_b"), "date_b",
        )
        .agg(F.count(F.lit(1)).alias("exempt"))
    )
    keys = ["set_a", "entities_a", "date_a", "set_b", "entities_b", "date_b"]
    found = met.join(exempt, keys, "left").withColumn("linked", F.lit(0))
    if item_urls is not None:
        found = found.drop("linked").join(_linked_pairs(keyed, item_urls, both.select("set_a", "set_b"), days), keys, "left")
    return (
        found.withColumn("n_pairs", F.col("pairs") - F.coalesce("exempt", F.lit(0)) - F.coalesce("linked", F.lit(0)))
        .filter("n_pairs > 0")
        .select(*keys, "n_pairs", "jaccard")
    )


def _earlier_items(members: DataFrame, met: DataFrame, parts: int | None) -> DataFrame:
    """(id, n): how many items of related cells come before each item, on an earlier date or on its own with a smaller id.

    members: id, issue_date, cell. met: cell, issue_date, other, other_date, m, with m the items of the other cell on its
    date; a cell also meets itself. Items are numbered once per pair of cells of a date, by a range shuffle, and the places
    are subtracted; no pair of items is made."""
    earlier = met.filter(F.col("other_date") < F.col("issue_date")).groupBy("cell", "issue_date").agg(F.sum("m").alias("earlier"))
    today = met.filter(F.col("other_date") == F.col("issue_date")).select(
        "cell", "issue_date", F.least("cell", "other").alias("low"), F.greatest("cell", "other").alias("high")
    )
    placed = rank_in_group(members.join(today, ["cell", "issue_date"]), ["low", "high", "issue_date"], [], "id", "place", parts)
    own = F.max(F.when(F.col("low") == F.col("high"), F.col("place")))
    before = placed.groupBy("id", "cell", "issue_date").agg((F.sum("place") - own * F.count(F.lit(1)) + own - 1).alias("before"))
    return before.join(earlier, ["cell", "issue_date"], "left").select(
        "id", "issue_date", (F.col("before") + F.coalesce("earlier", F.lit(0))).alias("n")
    )


def title_conflicts_by_item(
    items: DataFrame, tokens, item_urls: DataFrame, follow_ups: DataFrame, threshold: float = 0.5, days: int = 7,
    hot: int = HOT_TOKEN, parts: int | None = None,
) -> DataFrame:
    """(id, issue_date, n_conflicts): how many earlier items have a similar title and a common entity but no common link; a
    pair with a common link is reported by its link. Items of one title set, entities and links are one cell. The pairs
    that also share a link are counted apart, joined on (link, title set, date), and subtracted.

    items: id (unique), issue_date, entities. item_urls: id, issue_date, url, distinct. follow_ups: id, follow_up_of."""
    sets = distinct_sets(items, "id", tokens)
    both = stored(_both_ways(sets, threshold, hot).select("set_a", "set_b"), "similar")
    links = item_urls.groupBy("id").agg(F.array_sort(F.collect_set("url")).alias("links"))
    keyed = (
        set_members(items.withColumn("entities", F.array_sort("entities")), "id", tokens, sets).filter("set_id is not null")
        .select("id", "issue_date", "set_id", "entities")
        .join(links, "id", "left")
        .withColumn("links", F.coalesce("links", F.array().cast("array<string>")))
    )
    keyed = stored(keyed, "titled")
    sides = ["set_id", "entities", "links"]

    def counted(key: list[str]) -> tuple[DataFrame, DataFrame]:
        cells = keyed.groupBy(*key).agg(F.min("id").alias("cell"))
        members = keyed.join(cells, key)
        return members, members.groupBy("cell", "issue_date", *key).agg(F.count(F.lit(1)).alias("m"))

    def met(dated: DataFrame, keys: list[str], more) -> DataFrame:
        names = {"issue_date": "other_date", "cell": "other", "set_id": "set_b", "entities": "entities_b", "links": "links_b", "m": "m_b"}
        older = _reachable(dated.withColumnsRenamed(names), days, "issue_date", "other_date")
        newer = dated.drop("m").withColumnRenamed("set_id", "set_a").join(both, "set_a")
        return newer.join(older, [*keys, "set_b", "issue_date"]).filter(F.arrays_overlap("entities", "entities_b") & more).select(
            "cell", "issue_date", "other", "other_date", F.col("m_b").alias("m")
        )

    titled, dated = counted(sides[:2])
    similar = _earlier_items(titled.select("id", "issue_date", "cell"), met(dated, [], F.lit(True)), parts)
    linked, dated = counted(sides)
    by_link = dated.filter(F.size("links") > 0).withColumn("url", F.explode("links"))
    once = F.col("url") == F.array_min(F.array_intersect("links", "links_b"))  # a pair with several common links counts once
    shared = _earlier_items(linked.filter(F.size("links") > 0).select("id", "issue_date", "cell"), met(by_link, ["url"], once), parts)
    exempt = (
        _follow_up_pairs(keyed, follow_ups, sides, days)
        .filter(F.arrays_overlap("entities", "other_entities") & ~F.arrays_overlap("links", "other_links"))
        .join(both, (F.col("set_id") == F.col("set_a")) & (F.col("other_set_id") == F.col("set_b")), "left_semi")
        .select("id", F.lit(1).alias("exempt"))
    )
    left = F.col("n") - F.coalesce("shared", F.lit(0)) - F.coalesce("exempt", F.lit(0))
    return (
        similar.join(shared.select("id", F.col("n").alias("shared")), "id", "left").join(exempt, "id", "left")
        .select("id", "issue_date", left.alias("n_conflicts")).filter("n_conflicts > 0")
    )


def conflict_report(
    items: DataFrame, tokens, item_urls: DataFrame, follow_ups: DataFrame, threshold: float = 0.5, days: int = 7, parts: int | None = None
) -> DataFrame:
    """(id, issue_date, reason, n_conflicts, detail): one row per item and reason. `id`: uses of the id in the issue beyond the
    first; `url`: earlier items with a common link, counted per link, and the smallest such link; `title`: earlier items with a
    similar title and no common link."""
    same_id = duplicate_ids(items).select("id", "issue_date", F.lit("id").alias("reason"), "n_conflicts", F.lit("duplicate id").alias("detail"))
    single = items.dropDuplicates(["id"])
    by_link = url_conflicts_by_item(item_urls, follow_ups, days, parts).select("id", "issue_date", F.lit("url").alias("reason"), "n_conflicts", "detail")
    by_title = title_conflicts_by_item(single, tokens, item_urls, follow_ups, threshold, days, parts=parts).select(
        "id", "issue_date", F.lit("title").alias("reason"), "n_conflicts", F.lit(None).cast("string").alias("detail")
    )
    return same_id.unionByName(by_link).unionByName(by_title)
