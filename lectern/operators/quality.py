"""Data-quality checks: every rule is a DataFrame of what breaks it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.graphs import cut

#: Hexadecimal digits by which digests of rows are dealt into buckets.
BUCKET_DIGITS = 3


def violations(rules: dict[str, DataFrame]) -> DataFrame:
    """rule, n, example (smallest id as text): a row for each rule that something breaks. rules: frames with a column id."""
    parts = [df.select(F.lit(name).alias("rule"), F.col("id").cast("string").alias("id")) for name, df in rules.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("example"))


def pattern_counts(rows: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """name, n (matches), docs (texts with one): all patterns in one pass over the texts."""
    counts = F.array(*(F.struct(F.lit(k).alias("name"), F.regexp_count(text, F.lit(p)).alias("c")) for k, p in patterns.items()))
    e = rows.select(F.explode(counts).alias("x")).select("x.name", "x.c")
    return e.groupBy("name").agg(F.sum("c").cast("long").alias("n"), F.count_if(F.col("c") > 0).alias("docs"))


def malformed_rows(lines: DataFrame, line: str, pipes: int = 4) -> DataFrame:
    """Table lines whose number of unescaped pipes isn't what it should be."""
    bare = F.replace(F.col(line), F.lit("\\|"), F.lit(""))
    n = F.length(bare) - F.length(F.replace(bare, F.lit("|"), F.lit("")))
    return lines.where(F.startswith(F.ltrim(line), F.lit("|")) & (n != pipes))


def multiset_missing(want: DataFrame, got: DataFrame, text: str) -> DataFrame:
    """word, missing: words that want has more often than got, by counts."""
    words = lambda df, sign: df.select(F.explode(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ")).alias("word"), F.lit(sign).cast("long").alias("n"))
    both = words(want, 1).unionByName(words(got, -1)).where("word <> ''")
    return both.groupBy("word").agg(F.sum("n").alias("missing")).where("missing > 0")


def provenance_grade(matches: Column, corroborated: Column) -> Column:
    """A: corroborated and a match, or two; B: corroborated, or one match; C: neither."""
    n = F.size(F.filter(matches, lambda m: m))
    return F.when((corroborated & (n >= 1)) | (n >= 2), "A").when(corroborated | (n == 1), "B").otherwise("C")


def fingerprints(rows: DataFrame, by: list[str], ident: str, text: str) -> DataFrame:
    """by, print: a sha256 of the group's rows, whatever their order: each row's own (of its id and text, each followed by U+0001), then one over the sorted ones of each bucket (their first BUCKET_DIGITS digits), then one over the buckets.

    So no row holds a group's texts, nor all its digests."""
    one = F.sha2(F.concat(F.col(ident).cast("string"), F.lit("\u0001"), F.coalesce(text, F.lit("<missing>")), F.lit("\u0001")).cast("binary"), 256)
    d = rows.select(*by, one.alias("d")).withColumn("bucket", F.substring("d", 1, BUCKET_DIGITS))
    digest = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "").cast("binary"), 256)
    buckets = d.groupBy(*by, "bucket").agg(F.concat("bucket", digest("d")).alias("p"))
    return buckets.groupBy(*by).agg(digest("p").alias("print"))


def stale(stored: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """key, stale: stored prints that differ from the present ones or have none."""
    n = now.select(key, F.col("print").alias("now"))
    return stored.join(n, key, "left").select(key, F.coalesce(F.col("print") != F.col("now"), F.lit(True)).alias("stale"))


#: Characters of a chapter's name, its number left out, that a cover has to show.
CHAPTER_CHARS = 18
#: What the covers of a folder's two documents are called.
COVER_LABELS = {"QP": "QUESTIONS", "MS": "MARK SCHEME"}


def leaf_problems(plan: DataFrame, covers: DataFrame, pages: DataFrame, held: DataFrame, notes: DataFrame) -> DataFrame:
    """leaf, problem, detail: what folders that were built lack of their plan. plan: leaf, chapter (`number name`), year, tasks, files; covers: leaf, kind (QP or MS), text, tasks; pages: leaf, kind, page (from 1), banner; held: leaf, file; notes: leaf, text.

    A folder without one of its documents has that problem alone (QP before MS). Others: a cover without the chapter's name, the year or its label; covers of unlike tasks; QP tasks that aren't the plan's, as sets; the first page after the cover without a
    banner, for each document; files that aren't those of the plan; planned files that the notes don't mention (null notes mention none). Each check is a join on the folder; files meet as rows, so a folder's files are never held together.
    """
    have = covers.groupBy("leaf").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in COVER_LABELS))
    x = cut(plan.join(have, "leaf", "left"))  # every check goes over the folders, so they are worked out once
    lacks = [F.coalesce(F.col(k), F.lit(0)) == 0 for k in COVER_LABELS]
    missing = F.when(lacks[0], "QP").when(lacks[1], "MS")
    built = x.where(missing.isNull()).drop(*COVER_LABELS)
    problem = lambda df, name, detail: df.select("leaf", F.lit(name).alias("problem"), detail.cast("string").alias("detail"))
    out = [problem(x.where(missing.isNotNull()), "document missing", missing)]
    name = F.left(F.regexp_extract("chapter", r"^[^ ]* (.*)$", 1), F.lit(CHAPTER_CHARS))
    c = cut(built.select("leaf", name.alias("__name"), F.col("year").cast("string").alias("__year"), F.col("tasks").alias("__planned")).join(covers, "leaf").withColumn("__text", F.coalesce("text", F.lit(""))))
    label = F.element_at(F.create_map(*(F.lit(v) for kv in COVER_LABELS.items() for v in kv)), F.col("kind"))
    as_set = lambda t: F.array_sort(F.array_distinct(t))
    fault = lambda name, detail, wrong: F.when(wrong, F.struct(F.lit(name).alias("problem"), detail.cast("string").alias("detail")))
    own = [fault("cover without", F.concat_ws(" ", "kind", column), ~F.contains("__text", F.col(column))) for column in ("__name", "__year")]
    own += [fault("cover not labelled", F.col("kind"), ~F.contains("__text", label)), fault("tasks not planned", F.array_join("tasks", ","), (F.col("kind") == "QP") & ~as_set("tasks").eqNullSafe(as_set("__planned")))]
    out.append(c.select("leaf", F.explode(F.filter(F.array(*own), lambda f: f.isNotNull())).alias("f")).select("leaf", "f.*"))
    qp, ms = (c.where(F.col("kind") == k).select("leaf", F.col("tasks").alias(k)) for k in COVER_LABELS)
    out.append(problem(qp.join(ms, "leaf").where(~F.col("QP").eqNullSafe(F.col("MS"))), "covers disagree", F.lit(None)))
    bare = pages.where((F.col("page") > 1) & ~F.coalesce("banner", F.lit(False))).join(built.select("leaf"), "leaf", "left_semi").groupBy("leaf", "kind").agg(F.min("page").alias("page"))
    out.append(problem(bare, "page without banner", F.concat_ws(" ", "kind", "page")))
    files = built.select("leaf", F.explode("files").alias("file"))
    count = lambda df, n: df.groupBy("leaf", "file").agg(F.count(F.lit(1)).alias(n))
    own = held.join(built.select("leaf"), "leaf", "left_semi")
    both = count(files, "__want").join(count(own, "__got"), ["leaf", "file"], "full").where(~F.col("__want").eqNullSafe(F.col("__got")))
    out.append(problem(both, "file missing or not planned", F.col("file")))
    said = files.distinct().join(notes.select("leaf", F.col("text").alias("__note")), "leaf", "left").where(~F.contains(F.coalesce("__note", F.lit("")), F.col("file")))
    out.append(problem(said, "file not in notes", F.col("file")))
    return reduce(DataFrame.unionByName, out)
