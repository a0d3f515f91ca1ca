"""Counts, shares and distributions over unit rows.

Unit rows have: paper (group), q (question), marks (null or 0: none), year, season, tags (array of `topic.subtopic`). Every function is DataFrame to DataFrame; each shuffle aggregates partially first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Marks are split over up to so many tags in whole parts of this number, so sums don't depend on order.
SPLIT = 60


def topic_of(tag: Column) -> Column:
    return F.substring_index(tag, ".", 1)


def tag_counts(units: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """level, name, n, marks (in full for each tag), n_unique (without papers in duplicates): by topic and by subtopic in one pass."""
    u = units
    if duplicates is not None:
        u = u.join(duplicates.select("paper", F.lit(True).alias("dup")), "paper", "left")
    else:
        u = u.withColumn("dup", F.lit(None).cast("boolean"))
    t = u.select("dup", F.coalesce("marks", F.lit(0)).alias("marks"), F.explode("tags").alias("sub")).withColumn("topic", topic_of(F.col("sub")))
    agg = t.groupingSets([["topic"], ["sub"]], "topic", "sub").agg(F.count(F.lit(1)).alias("n"), F.sum("marks").alias("marks"), F.count_if(F.col("dup").isNull()).alias("n_unique"))
    return agg.select(F.when(F.col("topic").isNotNull(), "topic").otherwise("subtopic").alias("level"), F.coalesce("topic", "sub").alias("name"), "n", "marks", "n_unique")


def paper_share(units: DataFrame) -> DataFrame:
    """topic, papers, pct of all papers that have it."""
    n = units.agg(F.count_distinct("paper").alias("all_papers"))
    per = units.select("paper", F.explode("tags").alias("t")).select("paper", topic_of(F.col("t")).alias("topic")).groupBy("topic").agg(F.count_distinct("paper").alias("papers"))
    return per.crossJoin(F.broadcast(n)).select("topic", "papers", (100.0 * F.col("papers") / F.col("all_papers")).alias("pct"))


def split_marks(units: DataFrame, key: Column) -> DataFrame:
    """Marks of each unit split evenly over its distinct keys, in parts of SPLIT: columns paper, name, part."""
    names = F.array_distinct(F.transform("tags", lambda t: key(t)))
    marked = units.where(F.coalesce("marks", F.lit(0)) > 0).select("paper", "marks", names.alias("names"))
    return marked.select("paper", F.explode("names").alias("name"), F.expr(f"marks * ({SPLIT} div size(names))").cast("long").alias("part"))


def fractional_shares(units: DataFrame, presence: DataFrame | None = None) -> DataFrame:
    """topic, marks (split evenly over a unit's distinct topics), pct of all marks, papers and appears_pct from the presence rows (the units themselves by default). A topic of either side has a row."""
    shown = presence if presence is not None else units
    m = split_marks(units, topic_of).groupBy("name").agg(F.sum("part").alias("part"))
    total = m.agg(F.sum("part").alias("total"))
    seen = paper_share(shown).select(F.col("topic").alias("name"), "papers", F.col("pct").alias("appears_pct"))
    both = m.join(seen, "name", "full").crossJoin(F.broadcast(total))
    part = F.coalesce("part", F.lit(0))
    return both.select(
        F.col("name").alias("topic"),
        (part / SPLIT).alias("marks"),
        F.when(F.col("total") > 0, 100.0 * part / F.col("total")).otherwise(0.0).alias("pct"),
        F.coalesce("papers", F.lit(0)).alias("papers"),
        F.coalesce("appears_pct", F.lit(0.0)).alias("appears_pct"),
    )


def share_inside(units: DataFrame) -> DataFrame:
    """topic, sub, pct: each subtopic's part of its topic's marks (split over distinct subtopics)."""
    m = split_marks(units, lambda t: t).groupBy("name").agg(F.sum("part").alias("part")).withColumn("topic", topic_of(F.col("name")))
    return m.select("topic", F.col("name").alias("sub"), (100.0 * F.col("part") / F.sum("part").over(Window.partitionBy("topic"))).alias("pct"))


def histogram(units: DataFrame) -> DataFrame:
    """marks, n: marks that are null or 0 are left out."""
    return units.where(F.coalesce("marks", F.lit(0)) > 0).groupBy("marks").agg(F.count(F.lit(1)).alias("n"))


def sizes(units: DataFrame, by_question: bool = True) -> DataFrame:
    """marks, n, pct of questions (or parts) by their marks."""
    rows = units.groupBy("paper", "q").agg(F.sum("marks").alias("marks")) if by_question else units
    h = histogram(rows)
    return h.crossJoin(F.broadcast(h.agg(F.sum("n").alias("all_n")))).select("marks", "n", (100.0 * F.col("n") / F.col("all_n")).alias("pct"))


def question_marks(units: DataFrame) -> DataFrame:
    """q, n, mean (one decimal, half to even), least, most of questions' summed marks, without totals of 0."""
    t = units.groupBy("paper", "q").agg(F.sum("marks").alias("marks")).where("marks > 0")
    return t.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg("marks"), 1).alias("mean"), F.min("marks").alias("least"), F.max("marks").alias("most"))


def year_trend(units: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """year, topic, n; units of duplicate papers are left out."""
    u = units.join(duplicates, "paper", "left_anti") if duplicates is not None else units
    return u.select("year", F.explode("tags").alias("t")).groupBy("year", topic_of(F.col("t")).alias("topic")).agg(F.count(F.lit(1)).alias("n"))


def position_by_topic(units: DataFrame) -> DataFrame:
    """q, topic, n."""
    return units.select("q", F.explode("tags").alias("t")).groupBy("q", topic_of(F.col("t")).alias("topic")).agg(F.count(F.lit(1)).alias("n"))


def questions_per_paper(units: DataFrame, marked_only: bool = False) -> DataFrame:
    """One row: least, most, papers, fewest (papers at the least), newest (questions of the last paper by year, season and id). marked_only: questions with marks only."""
    rows = units.groupBy("paper", "q").agg(F.sum("marks").alias("m"), F.max(F.struct("year", "season")).alias("s"))
    rows = rows.where("m > 0") if marked_only else rows
    per = rows.groupBy("paper").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s"))
    ends = per.agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("papers"), F.max_by("n", F.struct("s", "paper")).alias("newest"))
    fewest = per.groupBy("n").agg(F.count(F.lit(1)).alias("fewest"))
    return ends.join(fewest, F.col("least") == F.col("n")).select("least", "most", "papers", "fewest", "newest")


def presence_split(units: DataFrame, year: int, least: float = 10.0) -> DataFrame:
    """topic, then, now: pct of papers that have it before and from a year (missing: 0), and retired, whether it was least or more and is gone. Full outer."""
    then = paper_share(units.where(F.col("year") < year)).select("topic", F.col("pct").alias("then"))
    now = paper_share(units.where(F.col("year") >= year)).select("topic", F.col("pct").alias("now"))
    both = then.join(now, "topic", "full").fillna(0.0, ["then", "now"])
    return both.withColumn("retired", (F.col("then") >= least) & (F.col("now") == 0))


def command_shares(units: DataFrame, command: str = "command") -> DataFrame:
    """command, parts, marks, pct of marks; null commands are left out."""
    g = units.where(F.col(command).isNotNull()).groupBy(F.col(command).alias("command")).agg(F.count(F.lit(1)).alias("parts"), F.sum(F.coalesce("marks", F.lit(0))).alias("marks"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("marks").alias("total")))).select("command", "parts", "marks", F.when(F.col("total") > 0, 100.0 * F.col("marks") / F.col("total")).otherwise(0.0).alias("pct"))


def command_sizes(units: DataFrame, command: str = "command") -> DataFrame:
    """command, parts, mean, most, at_top (parts with the most marks of all)."""
    u = units.where(F.coalesce("marks", F.lit(0)) > 0)
    top = u.agg(F.max("marks").alias("top"))
    return u.crossJoin(F.broadcast(top)).groupBy(F.col(command).alias("command")).agg(F.count(F.lit(1)).alias("parts"), F.avg("marks").alias("mean"), F.max("marks").alias("most"), F.count_if(F.col("marks") == F.col("top")).alias("at_top"))


def recency(units: DataFrame, last_n: int = 4) -> DataFrame:
    """topic, last_year, last_season, hits: the last sitting of each topic and in how many of the newest last_n sittings it was. The sittings are ranked on their own few rows."""
    s = units.select("year", "season").distinct().withColumn("rank", F.row_number().over(Window.orderBy(F.desc("year"), F.desc("season"))))
    t = units.select(F.explode("tags").alias("t"), "year", "season").select(topic_of(F.col("t")).alias("topic"), "year", "season").distinct()
    j = t.join(s, ["year", "season"])
    last = F.max(F.struct("year", "season"))
    return j.groupBy("topic").agg(last.alias("l"), F.count_if(F.col("rank") <= last_n).alias("hits")).select("topic", F.col("l.year").alias("last_year"), F.col("l.season").alias("last_season"), "hits")


def band(rows: DataFrame, value: str, lo: float, hi: float, by: list[str]) -> DataFrame:
    """Nearest-rank percentiles lo and hi of a value in each group and the pct of values inside the closed band. Equal values are counted first, and all else is read from the counts, so a task holds a group's distinct values and not its rows."""
    group = Window.partitionBy(*by)
    c = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    c = c.withColumns({"__seen": F.sum("__n").over(group.orderBy(value)), "__all": F.sum("__n").over(group)})
    at = lambda p: F.min(F.when(F.col("__seen") >= F.ceil(F.lit(p) * F.col("__all")), F.col(value))).over(group)
    c = c.withColumns({"lo": at(lo), "hi": at(hi)})
    inside = F.sum(F.when(F.col(value).between(F.col("lo"), F.col("hi")), F.col("__n")).otherwise(0))
    return c.groupBy(*by, "lo", "hi").agg(F.sum("__n").alias("n"), (100.0 * inside / F.sum("__n")).alias("inside_pct"))


def question_totals(units: DataFrame) -> DataFrame:
    return units.groupBy("paper", "q").agg(F.sum("marks").alias("total")).where("total > 0")


def topic_bands(units: DataFrame, lo: float = 0.25, hi: float = 0.75) -> DataFrame:
    """topic, lo, hi, n, inside_pct of the marks that a topic has in a paper (in parts of SPLIT)."""
    per = split_marks(units, topic_of).groupBy(F.col("name").alias("topic"), "paper").agg(F.sum("part").alias("part"))
    return band(per, "part", lo, hi, ["topic"])


def biggest_task(units: DataFrame) -> DataFrame:
    """One row: the question with the most marks (then the newest sitting, paper and number last), and the least and most of the other questions of its paper."""
    t = units.groupBy("paper", "q").agg(F.sum("marks").alias("total"), F.max(F.struct("year", "season")).alias("s")).where("total > 0")
    top = t.agg(F.max(F.struct("total", "s", "paper", "q")).alias("b")).select("b.*")
    rest = t.select(F.col("paper").alias("p"), F.col("q").alias("other"), F.col("total").alias("o"))
    j = F.broadcast(top).join(rest, (F.col("paper") == F.col("p")) & (F.col("q") != F.col("other")), "left")
    return j.groupBy("paper", "q", "total").agg(F.min("o").alias("least_other"), F.max("o").alias("most_other"))


def task_map(units: DataFrame, min_n: int = 10) -> DataFrame:
    """q, n, topic, hits: for each position in at least min_n papers the topic of most papers (the smaller name on ties)."""
    n = units.groupBy("q").agg(F.count_distinct("paper").alias("n")).where(F.col("n") >= min_n)
    h = units.select("q", "paper", F.explode("tags").alias("t")).groupBy("q", topic_of(F.col("t")).alias("topic")).agg(F.count_distinct("paper").alias("hits"))
    ranked = h.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("hits"), "topic"))).where("r = 1")
    return ranked.join(n, "q").select("q", "n", "topic", "hits")


def strongest_positions(units: DataFrame) -> DataFrame:
    """topic, q, n, share: the position where a topic is most usual (share, then papers, then the smaller position), of positions in at least half of the papers."""
    all_n = units.agg(F.ceil(F.count_distinct("paper") / 2).alias("half"))
    n = units.groupBy("q").agg(F.count_distinct("paper").alias("n"))
    h = units.select("q", "paper", F.explode("tags").alias("t")).groupBy("q", topic_of(F.col("t")).alias("topic")).agg(F.count_distinct("paper").alias("hits"))
    j = h.join(n, "q").crossJoin(F.broadcast(all_n)).where("n >= half").withColumn("share", 100.0 * F.col("hits") / F.col("n"))
    return j.groupBy("topic").agg(F.max(F.struct("share", "n", (-F.col("q")).alias("nq"))).alias("b")).select("topic", (-F.col("b.nq")).alias("q"), "b.n", "b.share")


def ladder(shares: DataFrame, want: list[tuple[str, float]]) -> DataFrame:
    """rank, topic, pct, running pct in order of falling pct, and reached: the first goal of want (name, pct) that this rung is the first to meet, or null. Rows are topics, so one task is enough."""
    w = Window.orderBy(F.desc("pct"), "topic")
    run = F.sum("pct").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = shares.select(F.row_number().over(w).alias("rank"), "topic", "pct", F.bround(run, 6).alias("running"))
    before = F.coalesce(F.lag("running").over(Window.orderBy("rank")), F.lit(0.0))
    reached = F.coalesce(*(F.when((F.col("running") >= goal) & (before < goal), F.lit(name)) for name, goal in want))
    return r.withColumn("reached", reached)


def pareto(rows: DataFrame, name: str, weight: str) -> DataFrame:
    """rank, name, weight, running pct of the whole in order of falling weight."""
    w = Window.orderBy(F.desc(weight), name)
    return rows.select(F.row_number().over(w).alias("rank"), F.col(name).alias("name"), F.col(weight).alias("weight"), (100.0 * F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) / F.sum(weight).over(Window.partitionBy())).alias("running_pct"))


def rollup_marks(units: DataFrame) -> DataFrame:
    """topic, sub, n, papers, marks at three levels (nulls: all of a level)."""
    t = units.select("paper", F.coalesce("marks", F.lit(0)).alias("marks"), F.explode("tags").alias("sub")).withColumn("topic", topic_of(F.col("sub")))
    return t.rollup("topic", "sub").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("paper").alias("papers"), F.sum("marks").alias("marks"))


def tier(n: Column, of: Column) -> Column:
    return F.when((n >= 2) & (n >= 0.5 * of), "core").when(n >= 2, "regular").otherwise("rare")


def reprinted(units: DataFrame, flag: str) -> DataFrame:
    """Papers of which half the parts or more are flagged as duplicates."""
    return units.groupBy("paper").agg(F.count_if(F.col(flag)).alias("d"), F.count(F.lit(1)).alias("n")).where("2 * d >= n").select("paper")


def reconciled(units: DataFrame, stated: Column) -> DataFrame:
    """Papers whose summed marks are the stated total, an expression over year."""
    return units.groupBy("paper").agg(F.sum("marks").alias("total"), F.min("year").alias("year")).where(F.col("total") == stated).select("paper", "total")


def function_families(texts: DataFrame, sitting: str, text: str, families: dict[str, dict[str, str]]) -> DataFrame:
    """family, sittings, members: in how many sittings a text matches any member's pattern, a sitting once, and the members with their own counts, the most frequent first. families: name -> member -> pattern."""
    flags = {m: F.max(F.col(text).rlike(p).cast("long")).alias(f"{f}/{m}") for f, ms in families.items() for m, p in ms.items()}
    s = texts.groupBy(sitting).agg(*flags.values())
    cell = lambda f, m: F.col(f"`{f}/{m}`")
    sums = s.agg(*(F.sum(cell(f, m)).alias(f"{f}/{m}") for f, ms in families.items() for m in ms), *(F.sum(F.greatest(*(cell(f, m) for m in ms), F.lit(0))).alias(f) for f, ms in families.items()))

    def members(f: str) -> Column:
        own = F.array_sort(F.array(*(F.struct((-cell(f, m)).alias("n"), F.lit(m).alias("m")) for m in families[f])))
        return F.array_join(F.transform(own, lambda x: F.concat_ws(" ", x["m"], (-x["n"]).cast("string"))), ", ")

    return sums.select(F.explode(F.array(*(F.struct(F.lit(f).alias("family"), F.col(f).alias("sittings"), members(f).alias("members")) for f in families))).alias("x")).select("x.*")


def report_scalars(shares: DataFrame) -> DataFrame:
    """One row: top3 (pct of the three largest topics), under (topics below 1 per cent), most, pair (the two largest). Shares that don't add up to 100 are an error."""
    ranked = shares.select("topic", "pct", F.row_number().over(Window.orderBy(F.desc("pct"), "topic")).alias("r"))
    top = F.array_sort(F.collect_list(F.when(F.col("r") <= 2, F.struct("r", "topic"))))
    one = ranked.agg(F.sum(F.when(F.col("r") <= 3, F.col("pct"))).alias("top3"), F.count_if(F.col("pct") < 1).alias("under"), F.max("pct").alias("most"), F.array_join(F.transform(top, lambda x: x["topic"]), " and ").alias("pair"), F.sum("pct").alias("all"))
    return one.select(F.when(F.abs(F.col("all") - 100) < 1e-6, F.col("top3")).otherwise(F.raise_error(F.lit("the shares don't add up"))).alias("top3"), "under", "most", "pair")


def position_rules(positions: DataFrame, over_topics: int, least_pct: float, firm: float) -> DataFrame:
    """q, topic, pct, grade of a map of positions (q, n, topic, hits), or no row if it has too few topics or no share of least_pct."""
    p = positions.select("q", "topic", (100.0 * F.col("hits") / F.col("n")).alias("pct"))
    rule = p.agg((F.count_distinct("topic") > over_topics).alias("many"), (F.max("pct") >= least_pct).alias("clear"))
    return p.crossJoin(F.broadcast(rule)).where("many and clear").select("q", "topic", "pct", F.when(F.col("pct") >= firm, "firm").otherwise("loose").alias("grade"))  # one row


def year_bounds(texts: DataFrame, stored: DataFrame) -> DataFrame:
    """paper, first, last, n: the years of a paper's texts (paper, year); an error if they aren't as many as its stored sittings (paper, sittings)."""
    g = texts.groupBy("paper").agg(F.min("year").alias("first"), F.max("year").alias("last"), F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("n") == F.col("sittings"), F.col("n")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("sittings differ:"), "paper")))
    return g.join(stored, "paper").select("paper", "first", "last", n.alias("n"))
