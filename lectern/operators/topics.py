"""Topic files: questions under their topics and subtopics, as blocks of Markdown in the order of a file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.papers import table_cell
from lectern.functions.text import code_parts

#: The order of blocks in a file.
ORDER = ["paper", "file", "kind", "sub_key", "sub", "level", "year", "season", "variant", "n", "q", "part", "id"]


def links(code: Column, suffix: Column) -> Column:
    """Links to a paper and to its scheme."""
    one = lambda c, word: F.concat(F.lit("[["), c, F.lit(f".pdf|{word}"), suffix, F.lit("]]"))
    return F.concat(one(code, "Question"), F.lit(" | "), one(F.replace(code, F.lit("_qp_"), F.lit("_ms_")), "Answer"))


def safe(name: Column) -> Column:
    return F.translate(name, "/:", "--")


def table(head: str, *cells: Column) -> Column:
    """A Markdown table of one row."""
    rule = "|" + "|".join(" --- " for _ in cells) + "|\n"
    return F.concat(F.lit(f"| {head} |\n{rule}| "), F.concat_ws(" | ", *cells), F.lit(" |\n"))


def groups(units: DataFrame) -> DataFrame:
    """The keepers, with codes, variants and labels (arrays: their own first, then those of the units that also_in names, in its order; names that no unit with a code has are left out)."""
    named = units.where("dupe_of is null").select(F.col("id").alias("keeper"), F.posexplode("also_in").alias("k", "id"))
    label = F.concat("q", F.coalesce("part", F.lit("")))
    again = named.join(units.where(code_parts(F.col("paper")).isNotNull()).select("id", "paper", label.alias("label")), "id").groupBy("keeper").agg(F.array_sort(F.collect_list(F.struct("k", "paper", "label"))).alias("more"))
    own = units.where(F.col("dupe_of").isNull() & code_parts(F.col("paper")).isNotNull()).join(again, F.col("id") == F.col("keeper"), "left").drop("keeper")
    more = F.coalesce("more", F.array().cast(again.schema["more"].dataType))
    return own.select("*", F.concat(F.array("paper"), F.transform(more, lambda m: m["paper"])).alias("codes"), F.concat(F.array(label), F.transform(more, lambda m: m["label"])).alias("labels")).drop("more")


def entry() -> Column:
    """The block of a question: a header with its papers, session and links, the question and its answer as tables."""
    first, variants = code_parts(F.col("paper")), F.transform("codes", lambda c: code_parts(c)["variant"])
    several = F.array_join(F.transform("codes", lambda c: links(c, F.concat(F.lit(" P"), code_parts(c)["variant"]))), " | ")
    head = F.concat(F.lit("#### P "), F.array_join(variants, " + "), F.lit(" | "), F.upper(first["session"]), F.lit(" "), first["year"].cast("string"), F.lit(" | "), F.when(F.size("codes") == 1, links(F.col("paper"), F.lit(""))).otherwise(several))
    number, marks = F.array_join("labels", " / "), F.coalesce(F.col("marks").cast("string"), F.lit(""))
    shown = lambda *c: table_cell(F.concat_ws("\n", *(F.when(F.trim(x) != "", F.col(x)) for x in c)))
    answer = F.when(F.trim(F.coalesce("ms", F.lit(""))) != "", table_cell(F.col("ms"))).otherwise("*Mark scheme is a diagram — see the linked PDF.*")
    return F.concat(head, F.lit("\n\n"), table("No. | Question | Marks", number, shown("stem", "part_stem", "text"), marks), F.lit("\n"), table("Question | Answer | Marks", number, answer, marks), F.lit("\n---\n"))


def topic_files(units: DataFrame, tags: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The blocks of all topic files: ORDER, and block (Markdown). units: id, paper (a code), q, part, stem, part_stem, text, ms, marks, dupe_of, also_in; tags: id, topics (subtopics); taxonomy: topic, topic_name, sub, sub_name.

    A file belongs to a paper and a topic: a title, and for each subtopic that has questions its heading and their entries by session, number and part. A reprint stands in its keeper's entry; a keeper under several subtopics has an entry under each;
    what has a malformed code, no tag, or only tags that the taxonomy lacks, is in no file. A row is one block, so no file is held together; sorted by ORDER they are the files.
    """
    g = groups(units)
    parts = code_parts(F.col("paper"))
    first = F.regexp_extract("q", "^[0-9]+", 0)
    body = g.select("id", entry().alias("block"), parts["paper_no"].alias("__paper"), parts["year"].alias("year"), parts["session"].alias("season"), parts["variant"].alias("variant"), F.coalesce(F.nullif(first, F.lit("")).cast("int"), F.lit(0)).alias("n"), "q", F.coalesce("part", F.lit("")).alias("part"))
    placed = tags.select("id", F.explode(F.array_distinct("topics")).alias("sub")).join(taxonomy.where("sub is not null"), "sub")
    file = F.concat(safe(F.col("topic")), F.lit(" "), safe(F.col("topic_name")))
    every = body.join(placed, "id").withColumnRenamed("__paper", "paper").withColumn("file", file).withColumn("sub_key", F.transform(F.split("sub", r"\."), lambda x: x.cast("int")))
    blank = {"year": "int", "season": "string", "variant": "string", "n": "int", "q": "string", "part": "string", "id": every.schema["id"].dataType.simpleString()}
    none = [F.lit(None).cast(t).alias(c) for c, t in blank.items()]
    entries = every.withColumns({"kind": F.lit(1), "level": F.lit(1)}).select(*ORDER, "block")
    heads = every.select("paper", "file", "sub_key", "sub", "sub_name").distinct().select("paper", "file", F.lit(1).alias("kind"), "sub_key", "sub", F.lit(0).alias("level"), *none, F.concat(F.lit("## "), "sub", F.lit(" "), "sub_name", F.lit("\n")).alias("block"))
    title = F.concat(F.lit("# "), "topic", F.lit(" "), "topic_name", F.lit(" — Paper "), "paper", F.lit("\n"))
    titles = every.select("paper", "file", "topic", "topic_name").distinct().select("paper", "file", F.lit(0).alias("kind"), F.lit(None).cast("array<int>").alias("sub_key"), F.lit(None).cast("string").alias("sub"), F.lit(0).alias("level"), *none, title.alias("block"))
    return reduce(DataFrame.unionByName, [titles, heads, entries])


def write_topic_files(files: DataFrame, path: str) -> None:
    """The blocks as text in a folder for each paper and file. A file lies in as many parts as it fills, whose names are in its order."""
    ranged = files.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ranged.select("paper", "file", F.col("block").alias("value")).write.mode("overwrite").partitionBy("paper", "file").text(path)
