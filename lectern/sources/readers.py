"""Readers: Markdown papers, JSON lines with later files winning, taxonomies, grade tables, archives, pages."""

from __future__ import annotations

import io
import zipfile
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import marks_in

UNIT = T.StructType([
    T.StructField("paper", T.StringType()), T.StructField("q", T.StringType()), T.StructField("part", T.StringType()), T.StructField("stem", T.StringType()), T.StructField("part_stem", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("ms", T.StringType()), T.StructField("marks", T.IntegerType()), T.StructField("split", T.StringType()), T.StructField("dupe_of", T.StringType()), T.StructField("also_in", T.ArrayType(T.StringType())),
])
TAGS = "id STRING, topics ARRAY<STRING>, confidence STRING, why STRING"


def question_bank(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of units, with an explicit schema: what a record lacks is null."""
    return spark.read.schema(UNIT).option("multiLine", True).json(path)


def tag_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of tags; of several lines for an id that of the later file, then the later place in it, wins. Blank and broken lines are left out."""
    lines = spark.read.schema(TAGS).json(path).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
    best = lines.where("id is not null").groupBy("id").agg(F.max_by(F.struct("topics", "confidence", "why"), F.struct("f", "b", "n")).alias("t"))
    return best.select("id", "t.*")


def taxonomy(text: DataFrame, column: str = "value") -> DataFrame:
    """topic, topic_name, sub, sub_name of a JSON map topic -> {name, subtopics: id -> name}."""
    m = F.from_json(column, "map<string,struct<name:string,subtopics:map<string,string>>>")
    t = text.select(F.explode(m).alias("topic", "t"))
    return t.select("topic", F.col("t.name").alias("topic_name"), F.explode_outer("t.subtopics").alias("sub", "sub_name"))


def newest_papers(text: DataFrame, column: str = "value") -> DataFrame:
    """code, paper, q, marks, tags, what of a JSON map code -> {paper, questions}; keys that begin with _ are left out."""
    m = F.from_json(column, "map<string,struct<paper:string,questions:array<struct<q:string,marks:int,tags:array<string>,what:string>>>>")
    kept = F.map_filter(m, lambda k, v: ~F.startswith(k, F.lit("_")))
    p = text.select(F.explode(kept).alias("code", "p")).select("code", "p.paper", F.explode("p.questions").alias("x"))
    return p.select("code", "paper", "x.*")


def markdown_questions(papers: DataFrame, ident: str = "paper", text: str = "text") -> DataFrame:
    """paper, q, header_marks, body, ms, marks: blocks that begin `## Question N - M marks`, cut at the first `### Mark scheme`; marks are those printed in the body, else those of a single `**Marks: n**`, else the header's (0 counts as missing)."""
    blocks = F.filter(F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=## Question )", -1), lambda b: F.startswith(b, F.lit("## Question ")))
    b = papers.select(F.col(ident).alias("paper"), F.posexplode(blocks).alias("ord", "block"))
    head = F.substring_index("block", "\n", 1)
    rest = F.expr("substring(block, instr(concat(block, '\n'), '\n') + 1)")
    cut = F.split(rest, r"(?m)^### Mark scheme[^\n]*\n?", 2)
    header = F.nullif(F.regexp_extract(head, r"([0-9]+) marks?", 1), F.lit("")).cast("long")
    ms = F.get(cut, F.lit(1))
    schemes = F.regexp_extract_all(F.coalesce(ms, F.lit("")), F.lit(r"\*\*Marks: *([0-9]+)\*\*"), F.lit(1))
    single = F.when(F.size(schemes) == 1, schemes[0].cast("long"))
    zero = lambda c: F.nullif(c, F.lit(0).cast("long"))
    return b.select("paper", "ord", F.regexp_extract(head, r"^## Question ([0-9]+)", 1).alias("q"), header.alias("header_marks"), F.trim(F.get(cut, F.lit(0))).alias("body"), F.trim(ms).alias("ms"), F.coalesce(zero(marks_in(F.get(cut, F.lit(0)))), zero(single), zero(header)).alias("marks"))


def grade_rows(texts: DataFrame, ident: str = "code", text: str = "text") -> DataFrame:
    """code, component, max, A to E from lines of a layout text such as `Component 11  70 55 46 38 30 23`; a dash is null."""
    pattern = r"(?m)^ *Component ([0-9]{2})((?: +(?:[0-9]+|[-–])){6}) *$"
    lines = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    r = texts.select(F.col(ident).alias("code"), F.explode(lines).alias("l"))
    cells = F.split(F.trim(F.regexp_extract("l", pattern, 2)), " +")
    number = lambda k: F.when(cells[k].rlike("^[0-9]+$"), cells[k].cast("int"))
    return r.select("code", F.regexp_extract("l", pattern, 1).alias("component"), *(number(k).alias(n) for k, n in enumerate(("max", "A", "B", "C", "D", "E"))))


def option_rows(texts: DataFrame, ident: str = "code", text: str = "text") -> DataFrame:
    """code, option, components, max, A_star, A to E from lines of a layout text such as `AX 400  11, 21, 31  - 250 210 170 130 90`; a dash is null, and so is a maximum that isn't printed."""
    pattern = r"(?m)^[ \t]*([A-Z]{2}[JN]?)[ \t]+(?:([0-9]{3})[ \t]+)?([0-9]{2}(?:,[ \t]*[0-9]{2})+)[ \t]+([0-9]+|[-–]+)((?:[ \t]+[0-9]+){5})[ \t]*$"
    r = texts.select(F.col(ident).alias("code"), F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("l"))
    part = lambda k: F.regexp_extract("l", pattern, k)
    number = lambda c: F.when(c.rlike("^[0-9]+$"), c.cast("int"))
    grades = F.split(F.trim(F.translate(part(5), "\t", " ")), " +")
    return r.select("code", part(1).alias("option"), F.split(part(3), r",[ \t]*").alias("components"), number(part(2)).alias("max"), number(part(4)).alias("A_star"), *(number(grades[k]).alias(n) for k, n in enumerate("ABCDE")))


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, length, modified of files, without their content."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
    return f.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def unpacked(spark: SparkSession, path: str, junk: str = r"^(__MACOSX|\._|Thumbs\.db|\.DS_Store)") -> DataFrame:
    """archive, name, content of all files in zip archives, those in archives inside included; a name that an archive has before gets __dupN. Broken archives have no rows. An archive is one row, so it must fit a worker."""

    def members(data: bytes) -> Iterator[tuple[str, bytes]]:
        try:
            z = zipfile.ZipFile(io.BytesIO(data))
        except zipfile.BadZipFile:
            return
        for info in sorted(z.infolist(), key=lambda i: i.filename):
            if info.is_dir():
                continue
            raw, name = z.read(info), info.filename.rsplit("/", 1)[-1]
            if name.lower().endswith(".zip"):
                yield from members(raw)
            else:
                yield name, raw

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, content in zip(b["path"].to_pylist(), b["content"].to_pylist()):
                seen: Counter[str] = Counter()
                for name, raw in members(content):
                    stem, dot, ext = name.rpartition(".")
                    out = name if not seen[name] else f"{stem if dot else name}__dup{seen[name]}{dot}{ext if dot else ''}"
                    seen[name] += 1
                    yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([out]), pa.array([raw], pa.binary())], ["archive", "name", "content"])

    z = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return z.mapInArrow(run, "archive string, name string, content binary").where(~F.col("name").rlike(junk))


def job_names(spark: SparkSession, sessions: list[str], years: range, variants: list[str], kinds: list[str]) -> DataFrame:
    """name: every code of a session, year, variant and kind."""
    one = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    years_ = spark.range(years.start, years.stop).select(F.lpad((F.col("id") % 100).cast("string"), 2, "0").alias("y"))
    g = one(sessions, "s").crossJoin(years_).crossJoin(one(kinds, "k")).crossJoin(one(variants, "v"))
    return g.select(F.concat(F.lit("9626_"), "s", "y", F.lit("_"), "k", F.lit("_"), "v").alias("name"))


