"""Operators behind reports: themes, ranges, tails, strips, tiers, checks of totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.operators.joins import small


def theme_counts(rows: DataFrame, ident: str, key: str, text: str, themes: list[tuple[str, str, list[str]]]) -> DataFrame:
    """key, theme, n: rows of a key whose text matches any pattern of a theme (key, theme, patterns; any case). One pass: each theme is a condition on its key."""
    hits = F.array(*(F.when((F.col(key) == k) & F.greatest(*(F.col(text).rlike(f"(?iu){p}") for p in [*ps, "$^"])), F.lit(name)) for k, name, ps in themes))
    e = rows.select(ident, key, F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("theme"))
    return e.groupBy(key, "theme").agg(F.count_distinct(ident).alias("n"))


def mention_rate(sections: DataFrame, report: str, text: str, pattern: str) -> DataFrame:
    """One row: mentioning, covering: reports with a section that matches, and all reports."""
    r = sections.groupBy(report).agg(F.max(F.col(text).rlike(pattern).cast("int")).alias("m"))
    return r.agg(F.sum("m").cast("long").alias("mentioning"), F.count(F.lit(1)).alias("covering"))


def folded_tail(rows: DataFrame, by: list[str], name: str, value: str, keep: int) -> DataFrame:
    """by, name, value: the keep largest of each group (the smaller name on ties) and the sum of the others as `rest`."""
    w = Window.partitionBy(*by).orderBy(F.desc(value), name)
    r = rows.withColumn("__r", F.row_number().over(w))
    return r.groupBy(*by, F.when(F.col("__r") <= keep, F.col(name)).otherwise("rest").alias(name)).agg(F.sum(value).alias(value))


def presence_strip(hits: DataFrame, columns: DataFrame, row: str, group: str, column: str) -> DataFrame:
    """row, column, state: hit, or present where another row of its group has a hit there, or absent. hits: row, group, column. The grid has a cell for each row and column; both are report dimensions."""
    h = hits.select(row, group, column).distinct()
    grid = h.select(row, group).distinct().crossJoin(small(columns.select(column).distinct()))
    own = h.withColumn("__hit", F.lit(True))
    near = h.select(group, column).distinct().withColumn("__near", F.lit(True))
    j = grid.join(own, [row, group, column], "left").join(near, [group, column], "left")
    return j.select(row, column, F.when(F.col("__hit"), "hit").when(F.col("__near"), "present").otherwise("absent").alias("state"))


def mark_ranges(units: DataFrame, by: list[str], sitting: str = "sitting", task: list[str] | None = None, part: str = "part") -> DataFrame:
    """by, then how many sittings there are and times, an array of struct(sitting, n) with the tasks of each; of the marks of tasks n, least, most, values (the distinct ones, sorted) and repeats (how many values occur more than once); and part_n, part_least,
    part_most, part_values and part_repeats, the same of the marks of parts. units: by, sitting, task (its columns), part (null: none), marks.

    A task's marks are summed over all its units, a part's over those of its task that name it, so the marks of a part come in its task's as well. Null sums count as tasks or parts, but are no values.
    """
    parts = units.groupBy(*by, sitting, *(task or ["task"]), part).agg(F.sum("marks").alias("m"))
    tasks = parts.groupBy(*by, sitting, *(task or ["task"])).agg(F.sum("m").alias("m"), F.collect_list(F.when(F.col(part).isNotNull(), F.struct("m"))).alias("ps"))
    fact = lambda kind, m=None, of=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None) if m is None else m).cast("long").alias("m"), (F.lit(None) if of is None else of).cast(dict(units.dtypes)[sitting]).alias("of"))
    facts = tasks.select(*by, F.explode(F.concat(F.array(fact("sitting", of=F.col(sitting)), fact("task", F.col("m"))), F.transform("ps", lambda p: fact("part", p["m"])))).alias("f"))
    g = facts.groupBy(*by, "f.kind", "f.m", "f.of").agg(F.count(F.lit(1)).alias("c"))

    def of(kind: str, name: str) -> list[Column]:
        own = lambda c: F.when(F.col("kind") == kind, c)
        m = own(F.col("m"))
        return [F.coalesce(F.sum(own(F.col("c"))), F.lit(0)).alias(f"{name}n"), F.min(m).alias(f"{name}least"), F.max(m).alias(f"{name}most"), F.array_sort(F.collect_list(m)).alias(f"{name}values"), F.count_if(m.isNotNull() & (F.col("c") > 1)).alias(f"{name}repeats")]

    seen = F.when(F.col("kind") == "sitting", F.struct(F.col("of").alias("sitting"), F.col("c").alias("n")))
    return g.groupBy(*by).agg(F.count(seen).alias("sittings"), F.array_sort(F.collect_list(seen)).alias("times"), *of("task", ""), *of("part", "part_"))


def total_check(units: DataFrame, most: int) -> DataFrame:
    """paper, total, off: papers whose marks differ from the stated most, and by how much."""
    t = units.groupBy("paper").agg(F.sum("marks").alias("total"))
    return t.where(F.col("total") != most).withColumn("off", F.col("total") - most)


def two_levels(units: DataFrame) -> DataFrame:
    """paper, q, command, marks: sums for each part and, with a null command, for the whole question."""
    return units.groupingSets([["paper", "q"], ["paper", "q", "command"]], "paper", "q", "command").agg(F.sum("marks").alias("marks"))


def constraint_breaks(units: DataFrame, lo: int, hi: int) -> DataFrame:
    """rule, paper: papers whose total lies outside lo to hi, and papers with a question twice."""
    total = units.groupBy("paper").agg(F.sum("marks").alias("t")).where(~F.col("t").between(lo, hi)).select(F.lit("total").alias("rule"), "paper")
    twice = units.groupBy("paper", "q").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("twice").alias("rule"), "paper").distinct()
    return total.unionByName(twice)


def splittable(inside: DataFrame, topics: DataFrame, first: int = 4) -> DataFrame:
    """topic, pct, lead, concentrated: the first topics (by pct) of at least 1 pct with several subtopics, the largest of which has under 97 pct of it. inside: topic, sub, pct; topics: topic, pct."""
    lead = inside.groupBy("topic").agg(F.max("pct").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1 and lead < 97")
    return topics.where("pct >= 1").join(lead, "topic").orderBy(F.desc("pct"), "topic").limit(first).select("topic", "pct", "lead", (F.col("lead") > 50).alias("concentrated"))


def collision_names(rows: DataFrame, name: str, suffix: Column, out: str) -> DataFrame:
    """rows with a suffix on names that occur more than once."""
    n = rows.groupBy(name).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(n, name).withColumn(out, F.when(F.col("__n") > 1, F.concat(name, F.lit("_"), suffix)).otherwise(F.col(name))).drop("__n")


def owners_in_order(rows: DataFrame, page: str, owner: str, order: str) -> DataFrame:
    """page, owners: all owners of a page in the order in which they are first seen."""
    f = rows.groupBy(page, owner).agg(F.min(order).alias("__first"))
    return f.groupBy(page).agg(F.array_sort(F.collect_list(F.struct("__first", owner))).alias("x")).select(page, F.transform("x", lambda s: s[owner]).alias("owners"))


def ordered_distinct(values: Column) -> Column:
    """The first of equal values of an array, in order."""
    return F.array_distinct(values)


def number_list(text: Column) -> Column:
    """Numbers of `7, 8 and 9` or of a range `14-16`, up to 20 wide."""
    lo, hi = (F.nullif(F.regexp_extract(text, r"^\s*([0-9]+)\s*[-–]\s*([0-9]+)", k), F.lit("")).cast("int") for k in (1, 2))
    return F.when(lo.isNotNull() & hi.between(lo, lo + 20), F.sequence(lo, hi)).otherwise(F.transform(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), lambda x: x.cast("int")))


def ref_parts(ref: Column) -> Column:
    """struct(sitting, task, part) of refs like `s24 1(c)`; part null without one."""
    rest = F.trim(F.substring_index(ref, " ", -1))
    return F.struct(F.substring_index(ref, " ", 1).alias("sitting"), F.substring_index(rest, "(", 1).alias("task"), F.when(F.contains(rest, F.lit("(")), F.concat(F.lit("("), F.regexp_extract(rest, r"\((.*)$", 1))).alias("part"))


def answer_lines(marks: Column) -> Column:
    """1.7 lines a mark, half to even, at least 3 and at most 34."""
    return F.greatest(F.lit(3), F.least(F.lit(34), F.bround(F.lit(1.7) * marks).cast("int")))


def split_or_whole(known: Column, hits: Column, pages: Column) -> Column:
    """split if two tasks or more are known and the hit pages are some, but at most 60 pct of the content; else whole."""
    return F.when((known >= 2) & (hits > 0) & (hits <= 0.6 * pages), "split").otherwise("whole")


def sentences(text: Column) -> Column:
    """Sentences with their marks."""
    return F.split(text, r"(?<=[.?])\s+")


def sentences_naming(rows: DataFrame, ident: str, text: str, word: str, lo: int = 31, hi: int = 699) -> DataFrame:
    """ident, sentence: sentences of lo to hi characters that hold a word or one that begins with it (any case)."""
    s = rows.select(ident, F.explode(sentences(F.col(text))).alias("sentence"))
    return s.where(F.length("sentence").between(lo, hi) & F.col("sentence").rlike(rf"(?i)(?U)\b{word}\w*"))


def reflowed(text: Column) -> Column:
    """Hard-wrapped lines joined: one that begins in lower case, with `/` or with `)` goes on from the line before."""
    return F.regexp_replace(text, r"\n(?=[a-z/)])", " ")


def routed(name: Column) -> Column:
    """Folder of a file: examiner reports and thresholds to their own, others by paper."""
    digit = F.regexp_extract(name, r"_([0-9])[0-9](\.[a-z]+)?$", 1)
    second = F.regexp_extract(name, r"_[0-9]([0-9])(\.[a-z]+)?$", 1)
    return F.when(F.contains(name, F.lit("_er")), "reports").when(F.contains(name, F.lit("_gt")), "thresholds").otherwise(F.concat(F.lit("paper"), F.when(digit == "0", second).otherwise(digit)))
