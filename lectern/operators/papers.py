"""Operators over papers: mark-scheme rows, report comments, owners of figures, thresholds, citations, archives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import papers as fn
from lectern.operators.graphs import cut
from lectern.operators.sequences import outermost

LABEL = r"^([1-9]|1[0-9]|20)(?:\s*\([a-h]\))?(?:\s*\([ivx]+\))?$"


def scheme_answers(rows: DataFrame) -> DataFrame:
    """paper, q, answer: the rows of a mark scheme's tables whose label is a question (`1`, `1(a)`, `6(a)(i)`), put together under its number. rows: paper, pos, label, cells. Other rows are left out."""
    r = rows.withColumn("q", F.nullif(F.regexp_extract(F.trim("label"), LABEL, 1), F.lit(""))).where("q is not null")
    text = fn.scheme_row(F.filter("cells", lambda x: x.isNotNull() & (x != "")))
    g = r.groupBy("paper", "q").agg(F.array_sort(F.collect_list(F.struct("pos", text.alias("t")))).alias("a"))
    return g.select("paper", "q", F.array_join(F.transform("a", lambda x: x["t"]), "\n\n").alias("answer"))


def task_rows(rows: DataFrame) -> DataFrame:
    """Rows of a scheme with the task in force: a row without a label continues the last labelled one. Rows of a table that lies within another are left out. rows: paper, pos, label, lo, hi (of its table)."""
    inner = rows.join(outermost(rows, ["paper"], "lo", "hi"), ["paper", "lo", "hi"], "left_semi")
    w = Window.partitionBy("paper").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return inner.withColumn("task", F.last("label", ignorenulls=True).over(w)).withColumn("continued", F.col("label").isNull())


# A table that starts above this height continues the last page's; cells of a column header; labels of tasks, headings that name one, and sum lines.
CONTINUATION_TOP, HEADER_HEIGHT = 130, 15
HEADER_CELLS = ("", "question", "answer", "marks", "task", "mark")
TASK_ROW, TASK_HEAD = r"^([0-9]{1,2})(?:\(|[ \t\n]|$)", r"(?i)^(?:See[ \t\n]+)?Tasks?[ \t\n]*([0-9]{1,2})"
SUM_LABEL, SUM_CELL = r"(?i)^(total|mark total)($|[^\p{L}\p{N}_])", r"^(available|total) marks($|[^\p{L}\p{N}_])"


def top_tables(rows: DataFrame) -> DataFrame:
    """rows of tables that lie in no other table of their page, with place: the table's from 1 on its page, by its upper end. rows: paper, page, table, lo, hi and others."""
    top = outermost(rows, ["paper", "page"], "lo", "hi")
    x = rows.join(top, ["paper", "page", "lo", "hi"], "left_semi")
    return x.withColumn("place", F.dense_rank().over(Window.partitionBy("paper", "page").orderBy("lo", "table")))


def header_row(cells: Column) -> Column:
    return F.forall(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))).isin(*HEADER_CELLS))


def labelled_rows(rows: DataFrame) -> DataFrame:
    """paper, label, page, table, n: every row of every table with a label, as it stands. rows: paper, page, table, n, cells."""
    label = F.trim(F.get("cells", F.lit(0)))
    return rows.withColumn("label", label).where("label <> ''").select("paper", "label", "page", "table", "n")


def part_rows(rows: DataFrame) -> DataFrame:
    """paper, page, table, n, label, continues: rows of the outer tables, column headers left out. label is without white space, null if empty: such a row goes on with the one before. continues marks the first row of a page whose first table
    starts at its top, where a row that the page break has cut goes on. rows: paper, page, table, lo, hi, n, cells."""
    x = top_tables(rows).where(~header_row(F.col("cells")))
    label = F.nullif(F.regexp_replace(F.coalesce(F.get("cells", F.lit(0)), F.lit("")), r"[\s]", ""), F.lit(""))
    first = F.row_number().over(Window.partitionBy("paper", "page").orderBy("place", "n")) == 1
    return x.select("paper", "page", "table", "n", label.alias("label"), (first & (F.col("place") == 1) & (F.col("lo") <= CONTINUATION_TOP)).alias("continues"))


def rows_by_task(rows: DataFrame, heads: DataFrame, tasks: int | None = None) -> DataFrame:
    """paper, page, table, n, task: rows of the outer tables, each with the task that is in force there, or null. rows: paper, page, table, lo, hi, n, cells, top, bottom (of the row); heads: paper, page, y, task, headings printed outside tables.

    A row labelled with a number starts that task. A row that names a task in words (`Task 4 - Webpage`) starts it too, unless rows so numbered came before: then it is a sub-heading within that task, and elsewhere the start of an appendix, which
    has no task and is left out itself. A table ends the task in force, unless it is the first of its page, starts at the top, and no heading of another task stands above it. Sum lines and column headers further down end it; they are left out. Rows of one n follow by the number that they name.

    So what happens is of three kinds: a task is set, none is, or one is kept only if it is that one. After something was set, it is in force until it is set anew or something else was to be kept: two running values over a paper's rows, no fold.

    tasks: over how many tasks papers are dealt, where the session's own number of partitions would hold too many rows each.
    """
    dealt = lambda df: df.repartition(tasks, "paper") if tasks else df
    rows = dealt(rows)
    cell = F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    low = F.transform("cells", lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    x = top_tables(rows).withColumns({"m": F.nullif(F.regexp_extract(cell, TASK_ROW, 1), F.lit("")), "h": F.nullif(F.regexp_extract(cell, TASK_HEAD, 1), F.lit("")), "some": F.exists(low, lambda c: c != "")})
    head = header_row(F.col("cells")) & (F.col("some") | (F.col("bottom") - F.col("top") < HEADER_HEIGHT))
    total = cell.rlike(SUM_LABEL) | F.exists(low, lambda c: c.rlike(SUM_CELL))
    kind = F.when(F.col("m").isNotNull(), "number").when(F.col("h").isNotNull(), "heading").when(head, "header").when(total, "sum").otherwise("row")
    at = F.struct("page", "place", "n")
    x = x.withColumns({"kind": kind, "at": at, "pos": F.struct("page", "place", F.lit(1).alias("late"), "n", F.coalesce("m", "h").alias("named"))})
    x = x.withColumn("seen", F.min(F.when(F.col("kind") == "number", F.col("at"))).over(Window.partitionBy("paper", F.coalesce("m", "h"))))
    again = (F.col("kind") == "heading") & F.coalesce(F.col("seen") < F.col("at"), F.lit(False))
    ends = (F.col("kind") == "sum") | ((F.col("kind") == "header") & F.col("some") & (F.col("top") > CONTINUATION_TOP))
    sets = (F.col("kind") == "number") | ((F.col("kind") == "heading") & ~again)
    x = x.select("paper", "page", "table", "n", "pos", "kind", again.alias("again"), (sets | ends).alias("fresh"), F.when(sets, F.coalesce("m", "h")).alias("set"), F.when(again, F.col("h")).alias("keep"))
    tables = top_tables(rows).select("paper", "page", "table", "place", "lo").distinct()
    above = tables.join(heads, ["paper", "page"]).where("y < lo").groupBy("paper", "page", "table").agg(F.min("task").alias("one"), F.max("task").alias("other"))
    t = tables.join(above, ["paper", "page", "table"], "left")
    new = (F.col("place") > 1) | (F.col("lo") > CONTINUATION_TOP) | F.coalesce(F.col("one") != F.col("other"), F.lit(False))
    start = F.struct("page", "place", F.lit(0).alias("late"), F.lit(None).cast(rows.schema["n"].dataType).alias("n"), F.lit(None).cast("string").alias("named"))
    none = lambda kind: F.lit(None).cast(kind)
    t = t.select("paper", "page", "table", none(rows.schema["n"].dataType).alias("n"), start.alias("pos"), F.lit("table").alias("kind"), F.lit(False).alias("again"), new.alias("fresh"), none("string").alias("set"), F.when(~new, F.col("one")).alias("keep"))
    order = Window.partitionBy("paper").orderBy("pos")
    e = dealt(x.unionByName(t)).withColumn("run", F.sum(F.col("fresh").cast("int")).over(order))  # what happened since the last time that something was set
    e = e.withColumn("held", F.max("set").over(Window.partitionBy("paper", "run")))
    off = F.max((F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.col("held"))).cast("int")).over(Window.partitionBy("paper", "run").orderBy("pos"))
    e = e.withColumn("task", F.when(off == 0, F.col("held")))
    return e.where("kind in ('number', 'row') or (kind = 'heading' and not (again and task is null))").select("paper", "page", "table", "n", "task")


def answer_pages(wanted: DataFrame, labels: DataFrame) -> DataFrame:
    """paper, q, part, page, n, by: the page with most rows (then the first) labelled exactly `q(part)`, else of all rows whose label begins `q(`; null if neither. wanted: paper, q, part; labels: paper, label, page."""
    exact = F.concat("q", F.lit("("), "part", F.lit(")"))
    keyed = labels.withColumn("base", F.substring_index("label", "(", 1))
    j = wanted.join(keyed.withColumnRenamed("base", "q"), ["paper", "q"]).withColumn("same", F.col("label") == exact)
    pages = j.where(F.col("same") | F.contains("label", F.lit("("))).groupBy("paper", "q", "part", "same", "page").agg(F.count(F.lit(1)).alias("n"))
    best = pages.groupBy("paper", "q", "part").agg(F.max(F.struct("same", "n", (-F.col("page")).alias("p"))).alias("b"))
    return wanted.join(best, ["paper", "q", "part"], "left").select("paper", "q", "part", (-F.col("b.p")).alias("page"), F.col("b.n").alias("n"), F.when(F.col("b.same"), "label").when(~F.col("b.same"), "prefix").alias("by"))


def comments(parts: DataFrame, sections: DataFrame) -> DataFrame:
    """parts (session, component, q, part) with text and scope of the first section (by page) that mentions the question; nulls if none. sections: session, component, page, text."""
    j = parts.join(sections, ["session", "component"]).withColumn("c", fn.report_comment(F.col("text"), F.col("q"), F.col("part"))).where("c is not null")
    first = j.groupBy("session", "component", "q", "part").agg(F.min_by("c", "page").alias("c"))
    f = first.select(F.col("session").alias("s"), F.col("component").alias("k"), F.col("q").alias("n"), F.col("part").alias("p"), "c")
    same = (F.col("session") == F.col("s")) & (F.col("component") == F.col("k")) & (F.col("q") == F.col("n")) & F.col("part").eqNullSafe(F.col("p"))
    return parts.join(f, same, "left").select("session", "component", "q", "part", "c.text", "c.scope")


def figure_owners(starts: DataFrame, figures: DataFrame) -> DataFrame:
    """doc, figure, start: the question that a figure belongs to, the last that starts at its middle or above. A figure in which another question starts is left out, and so is one above all. starts: doc, y; figures: doc, figure, lo, hi.

    Each figure looks three places up (its ends and its middle) along one ordering of starts and places."""
    probes = figures.select("doc", "figure", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), c.cast("double").alias("y")) for k, c in (("lo", F.col("lo")), ("mid", (F.col("lo") + F.col("hi")) / 2), ("hi", F.col("hi")))))).alias("p"))
    rows = probes.select("doc", "figure", "p.k", "p.y", F.lit(None).cast("double").alias("start"), F.lit(1).alias("late"))
    at = F.col("y").cast("double")
    rows = rows.unionByName(starts.select("doc", F.lit(None).cast(figures.schema["figure"].dataType).alias("figure"), F.lit(None).cast("string").alias("k"), at.alias("y"), at.alias("start"), F.lit(0).alias("late")))
    w = Window.partitionBy("doc").orderBy("y", "late").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("owner", F.last("start", ignorenulls=True).over(w)).where("figure is not null")
    g = found.groupBy("doc", "figure").agg(*(F.max(F.when(F.col("k") == k, F.col("owner"))).alias(k) for k in ("lo", "mid", "hi")))
    return g.where(F.col("lo").eqNullSafe(F.col("hi")) & F.col("mid").isNotNull()).select("doc", "figure", F.col("mid").alias("start"))


def grown_spans(owners: DataFrame, figures: DataFrame) -> DataFrame:
    """doc, start, lo, hi, n: what the figures of each question reach over."""
    return owners.join(figures, ["doc", "figure"]).groupBy("doc", "start").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n"))


def thresholds(rows: DataFrame, grades: list[str]) -> DataFrame:
    """session, grade, pct and raw (means over a session's variants) and max of the first variant. rows: session, variant, max and a column for each grade."""
    long = rows.select("session", "variant", "max", F.explode(F.array(*(F.struct(F.lit(g).alias("grade"), F.col(g).alias("mark")) for g in grades))).alias("x"))
    g = long.groupBy("session", F.col("x.grade").alias("grade"))
    return g.agg(F.avg(F.col("x.mark") * 100.0 / F.col("max")).alias("pct"), F.avg("x.mark").alias("raw"), F.min_by("max", "variant").alias("max"))


def inputs_named(texts: DataFrame) -> DataFrame:
    """paper, id, name: files that a text names, without those that its paper says anywhere to save. texts: paper, id, text."""
    saved = texts.select("paper", F.explode(fn.names_saved(F.col("text"))).alias("low")).distinct()
    named = texts.select("paper", "id", F.explode(fn.file_names(F.col("text"))).alias("name")).where(~F.col("name").rlike(r"^[0-9]+\.[0-9]+$"))
    return named.withColumn("low", F.lower("name")).join(saved, ["paper", "low"], "left_anti").select("paper", "id", "name")


def files_named(texts: DataFrame, files: DataFrame) -> DataFrame:
    """paper, id, file: the files of its paper that a text names (see names_file). texts: paper, id, text; files: paper, stem, ending."""
    j = texts.join(files, "paper").where(fn.names_file(F.col("text"), F.col("stem"), F.col("ending")))
    return j.select("paper", "id", F.concat_ws(".", "stem", "ending").alias("file"))


def cites(documents: DataFrame, ident: str, value: str) -> DataFrame:
    """ident, depth, doc, quote, page of every object, at any depth and under any key, that has both a doc and a quote (be they null). value: a VARIANT column (see parse_json).

    A level at a time: what lies in the objects and lists of one level is the next one, until nothing lies deeper; so there are as many rounds as the deepest value has levels. A null value has none."""
    kind = lambda c: F.schema_of_variant(c)
    has = lambda key: F.variant_get("v", f"$.{key}", "variant").isNotNull()
    level, found, depth = documents.select(ident, F.col(value).alias("v")).where("v is not null"), [], 0
    while True:
        level = cut(level.withColumn("__k", kind(F.col("v"))).where("__k like 'OBJECT<%' or __k like 'ARRAY<%'"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found) if found else level.select(ident, F.lit(0).alias("depth"), *(F.lit(None).cast(t).alias(c) for c, t in (("doc", "string"), ("quote", "string"), ("page", "int"))))
        own = level.where((F.col("__k").like("OBJECT<%")) & has("doc") & has("quote"))
        text = lambda key, t: F.try_variant_get("v", f"$.{key}", t).alias(key)
        found.append(own.select(ident, F.lit(depth).alias("depth"), text("doc", "string"), text("quote", "string"), text("page", "int")))
        level = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("v").outer())).select(ident, F.col("value").alias("v"))
        depth += 1


# An entry's heading (code, session, year, links), a link, the head of its table and how many lines below the heading that may stand.
ENTRY, LINK, TABLE_HEAD, LOOK_AHEAD = r"^### ([0-9]{4}/[0-9]{2}) ([msw]) ([0-9]{4})(.*)$", r"\[[^\]]*\]\(([^)]*)\)", "| No.", 7


def topic_entries(lines: DataFrame) -> DataFrame:
    """file, pos, paper, scheme, q, label: the entries of a topic file. lines: file, pos, line.

    A heading with two links at least is one, if a table's head stands within LOOK_AHEAD lines below it: the question is then the first cell of the table's first row, two lines below its head, as far as a slash. Each heading sees the lines right
    below it only, so files are gone through once."""
    w = Window.partitionBy("file").orderBy("pos")
    head = F.when(F.startswith("line", F.lit(TABLE_HEAD)), F.struct(F.lead("line", 2).over(w).alias("row")))
    x = lines.withColumn("__head", head).withColumn("__row", F.first("__head", ignorenulls=True).over(w.rowsBetween(1, LOOK_AHEAD)))
    links = F.regexp_extract_all(F.regexp_extract("line", ENTRY, 4), F.lit(LINK), F.lit(1))
    cell = F.regexp_extract(F.col("__row.row"), r"^\|[ \t]*([^|]+?)[ \t]*\|", 1)
    x = x.where(F.col("line").rlike(ENTRY)).withColumns({"__links": links, "__cell": cell}).where((F.size("__links") >= 2) & (F.col("__cell") != ""))
    label = F.concat_ws(" ", F.regexp_extract("line", ENTRY, 1), fn.session_name(F.concat(F.regexp_extract("line", ENTRY, 2), F.substring(F.regexp_extract("line", ENTRY, 3), 3, 2))))
    return x.select("file", "pos", F.get("__links", F.lit(0)).alias("paper"), F.get("__links", F.lit(1)).alias("scheme"), F.trim(F.substring_index("__cell", "/", 1)).alias("q"), label.alias("label"))


#: Bytes above which a copy of equal size counts as equal without a look at its content.
DIGEST_LIMIT = 12 << 20


def compared_copies(own: DataFrame, copies: DataFrame, limit: int = DIGEST_LIMIT) -> DataFrame:
    """name, host, size, match, how: what each copy of a file shows. own: name, content (binary); copies: name, host, content, error (text, where nothing came).

    By size first (`size`: they differ); only copies of equal size up to limit are digested (`md5`), larger ones count as equal (`size only`); an error or a missing content is told as it is. Names without a file of our own are left out."""
    mine = own.select("name", F.octet_length("content").alias("__size"), F.when(F.octet_length("content") <= limit, F.md5("content")).alias("__md5"))
    j = copies.withColumns({"size": F.octet_length("content")}).join(mine, "name")
    same = F.col("size") == F.col("__size")
    how = F.when(F.col("content").isNull(), F.coalesce("error", F.lit("no content"))).when(~same, "size").when(F.col("size") > limit, "size only").otherwise("md5")
    match = F.when(F.col("content").isNull(), None).when(~same, F.lit(False)).when(F.col("size") > limit, F.lit(True)).otherwise(F.md5("content") == F.col("__md5"))
    return j.select("name", "host", "size", match.alias("match"), how.alias("how"))


def placed_units(lines: DataFrame, line: str = "line") -> DataFrame:
    """label, q: distinct units that citation lines such as `label • Question 3` name; continuations are left out."""
    pattern = r"^(\S.*?)\s+[•·∙]\s+Question (\S+?)(\s+\(continued\))?$"
    m = lines.where(F.col(line).rlike(pattern) & (F.regexp_extract(line, pattern, 3) == ""))
    return m.select(F.regexp_extract(line, pattern, 1).alias("label"), F.regexp_extract(line, pattern, 2).alias("q")).distinct()


def topic_file_stats(lines: DataFrame) -> DataFrame:
    """file, entries, marks, years: headings, summed marks of rows with four cells, and years of the headings with their counts. lines: file, line."""
    cell = F.nullif(F.regexp_extract("line", r"^\|[ \t]*[^|]+\|[^|]*\|[ \t]*([0-9]+)[ \t]*\|[ \t]*$", 1), F.lit("")).cast("long")
    heading = F.startswith("line", F.lit("### "))
    x = lines.select("file", heading.alias("h"), cell.alias("m"), F.when(heading, F.nullif(F.regexp_extract("line", r"(20[0-9]{2})", 1), F.lit(""))).alias("y"))
    g = x.groupBy("file").agg(F.count_if("h").alias("entries"), F.coalesce(F.sum("m"), F.lit(0)).alias("marks"))
    years = x.where("y is not null").groupBy("file", "y").agg(F.count(F.lit(1)).alias("n")).groupBy("file").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "y", "n"))), " ").alias("years"))
    return g.join(years, "file", "left")


def resolved_pages(hits: DataFrame, content: DataFrame) -> DataFrame:
    """paper, mode, pages: `split` with the pages of the wanted tasks if the scheme has two tasks or more and they are some, but at most 60 % of the content; else `whole` with all. hits: paper, tasks, pages; content: paper, content."""
    ok = (F.coalesce("tasks", F.lit(0)) >= 2) & (F.coalesce(F.size("pages"), F.lit(0)) > 0) & (F.size("pages") <= 0.6 * F.greatest(F.size("content"), F.lit(1)))
    j = content.join(hits, "paper", "left").withColumn("ok", F.coalesce(ok, F.lit(False)))
    return j.select("paper", F.when(F.col("ok"), "split").otherwise("whole").alias("mode"), F.when(F.col("ok"), F.array_sort("pages")).otherwise(F.col("content")).alias("pages"))
