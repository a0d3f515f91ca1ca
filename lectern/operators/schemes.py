"""Questions cut into parts and their mark schemes cut to match. All of it works within a row, so nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import alnum_norm

# A part's label, labels that are roman numbers, the mark of a part, the line that ends a block of a scheme.
PART = r"(?i)^[ \t]*-[ \t]*\(([a-z]|i{1,3}|iv|v|vi{1,3})\)[ \t]*"
ROMANS = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii")
MARK = r"\*\*\[([0-9]+)\]\*\*"
BLOCK_END = r"^[ \t]*\*\*Marks:[ \t]*([0-9]+)\*\*[ \t]*$"
#: Words of a part by which its place in a scheme is found.
ANCHOR_WORDS = 6


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def between(lines: Column, start: Column, end: Column) -> Column:
    """Lines from place start up to before end, counted from 0, as one text."""
    return F.array_join(F.slice(lines, start + 1, F.greatest(end - start, F.lit(0))), "\n")


def printed_marks(text: Column) -> Column:
    """The marks that a text prints, summed; null if it prints none."""
    found = F.regexp_extract_all(text, F.lit(MARK), F.lit(1))
    return F.when(F.size(found) > 0, F.aggregate(found, F.lit(0).cast("long"), lambda s, x: s + x.cast("long")))


def question_leaves(text: Column) -> Column:
    """struct(stem, parts): parts are the leaves of a question in order, array of struct(label, stem, text). A letter with roman parts is no leaf; its own text is their stem. A roman label counts as one only after the first label."""

    def of(lines: Column) -> Column:
        starts = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(PART), F.struct(i.alias("at"), F.lower(F.regexp_extract(x, PART, 1)).alias("label")))), lambda s: s.isNotNull())

        def nodes(s: Column) -> Column:
            def node(x: Column, k: Column) -> Column:
                rest = between(lines, x["at"] + 1, F.coalesce(F.get(s, k + 1)["at"], F.size(lines)))
                own = F.concat(F.regexp_replace(F.get(lines, x["at"]), PART, ""), F.lit("\n"), rest)
                return F.struct(x["label"].alias("label"), ((k > 0) & x["label"].isin(*ROMANS)).alias("roman"), stripped(own).alias("text"))

            return F.transform(s, node)

        def leaves(n: Column) -> Column:
            def leaf(x: Column, k: Column) -> Column:
                above = F.try_element_at(F.filter(F.slice(n, F.lit(1), k), lambda y: ~y["roman"]), F.lit(-1))
                part = F.struct(F.concat(F.lit("("), above["label"], F.lit(")("), x["label"], F.lit(")")).alias("label"), above["text"].alias("stem"), x["text"].alias("text"))
                alone = F.struct(F.concat(F.lit("("), x["label"], F.lit(")")).alias("label"), F.lit("").alias("stem"), x["text"].alias("text"))
                return F.when(x["roman"], part).when(~F.coalesce(F.get(n, k + 1)["roman"], F.lit(False)), alone)

            return F.filter(F.transform(n, leaf), lambda p: p.isNotNull())

        return let(starts, lambda s: F.struct(stripped(between(lines, F.lit(0), F.coalesce(F.get(s, F.lit(0))["at"], F.size(lines)))).alias("stem"), let(nodes(s), leaves).alias("parts")))

    return let(F.split(F.coalesce(text, F.lit("")), "\n", -1), of)


def scheme_blocks(scheme: Column) -> Column:
    """array of struct(text, marks): a block ends at each `**Marks: N**` line. What follows the last belongs to its block; a scheme without such a line is one block without marks, or none if it is blank."""

    def of(lines: Column) -> Column:
        ends = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(BLOCK_END), F.struct(i.alias("at"), F.regexp_extract(x, BLOCK_END, 1).cast("long").alias("marks")))), lambda e: e.isNotNull())

        def blocks(e: Column) -> Column:
            tail = stripped(between(lines, F.coalesce(F.try_element_at(e, F.lit(-1))["at"] + 1, F.lit(0)), F.size(lines)))

            def block(x: Column, k: Column) -> Column:
                own = stripped(between(lines, F.coalesce(F.get(e, k - 1)["at"] + 1, F.lit(0)), x["at"]))
                return F.struct(F.when((k == F.size(e) - 1) & (tail != ""), F.concat(own, F.lit("\n\n"), tail)).otherwise(own).alias("text"), x["marks"].alias("marks"))

            none = F.array().cast("array<struct<text:string,marks:bigint>>")
            return F.when(F.size(e) > 0, F.transform(e, block)).when(tail != "", F.array(F.struct(tail.alias("text"), F.lit(None).cast("long").alias("marks")))).otherwise(none)

        return let(ends, blocks)

    return let(F.split(F.coalesce(scheme, F.lit("")), "\n", -1), of)


def anchor_keys(parts: Column) -> Column:
    """The first words of each part in normal form, without marks and remarks in brackets: schemes reprint them as headings."""
    plain = lambda p: F.regexp_replace(F.regexp_replace(p, MARK, " "), r"\([^)]*\)", " ")
    return F.transform(parts, lambda p: F.array_join(F.slice(F.split(alnum_norm(plain(p)), " "), 1, ANCHOR_WORDS), " "))


def anchored(scheme: Column, parts: Column) -> Column:
    """The scheme's text of each part, cut at the lines where the first words of the parts stand; null unless all are found in order, each on a later line.

    Each search goes on where the one before has ended, over the scheme's lines in normal form put end to end; the place tells the line.
    """

    def of(lines: Column) -> Column:
        flat = F.transform(lines, lambda x: F.concat(alnum_norm(x), F.lit(" ")))

        def find(f: Column) -> Column:
            whole = F.array_join(f, "")
            starts = F.aggregate(f, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.try_element_at(s, F.lit(-1)) + F.length(x))))

            def step(state: Column, key: Column, w: Column, at: Column) -> Column:
                return let(F.call_function("locate", key, w, state["from"]), lambda p: let(F.size(F.filter(at, lambda a: a < p)) - 1, lambda line: F.when(
                    (key != "") & (p > 0) & (F.coalesce(F.try_element_at(state["cuts"], F.lit(-1)), F.lit(-1)) < line),
                    F.struct((p + F.length(key)).alias("from"), F.concat(state["cuts"], F.array(line)).alias("cuts")))))

            begun = F.struct(F.lit(1).alias("from"), F.array().cast("array<int>").alias("cuts"))
            cuts = let(F.struct(whole.alias("w"), F.slice(starts, F.lit(1), F.size(f)).alias("at")), lambda x: F.aggregate(anchor_keys(parts), begun, lambda s, k: F.when(s.isNotNull(), step(s, k, x["w"], x["at"])))["cuts"])
            return let(cuts, lambda c: F.transform(c, lambda x, k: stripped(between(lines, F.when(k == 0, 0).otherwise(x), F.coalesce(F.get(c, k + 1), F.size(lines))))))

        return let(flat, find)

    bare = F.regexp_replace(F.coalesce(scheme, F.lit("")), r"(?m)^\s*\*\*Marks:\s*\d+\*\*\s*$", "")
    return F.when(F.size(parts) > 0, let(F.split(bare, "\n", -1), of))


def question_units(questions: DataFrame, text: str = "text", scheme: str = "scheme", stated: str = "stated") -> DataFrame:
    """questions (text, scheme, stated, and others, which stay) as units: nth (from 0), part, stem, part_stem, own, answer, marks, split.

    If a question has as many leaves as its scheme has blocks they go together by place. Else, if each leaf prints marks and they add up to the question's, the scheme is cut where it reprints the leaves' first words. Else the question stays
    whole (`whole`; `single` if it has no parts) rather than with an answer of another part. Marks are those printed, else those of the block, else for a question as a whole those stated.
    """
    kept = [c for c in questions.columns if c not in (text, scheme, stated)]
    x = questions.withColumns({"__l": question_leaves(F.col(text)), "__b": scheme_blocks(F.col(scheme)), "__all": printed_marks(F.col(text))})
    marks = F.transform("__l.parts", lambda p: printed_marks(p["text"]))
    sums = F.aggregate(marks, F.lit(0).cast("long"), lambda s, m: s + m)  # null if one is
    aligned = (F.size("__l.parts") > 0) & (F.size("__l.parts") == F.size("__b"))
    x = x.withColumns({"__marks": marks, "__aligned": aligned})
    x = x.withColumn("__cut", F.when(~F.col("__aligned") & (sums == F.col("__all")), anchored(F.col(scheme), F.transform("__l.parts", lambda p: p["text"]))))

    def unit(p: Column, i: Column) -> Column:
        block = F.get("__b", i)
        return F.struct(p["label"].alias("part"), F.col("__l.stem").alias("stem"), p["stem"].alias("part_stem"), p["text"].alias("own"), F.when(F.col("__aligned"), block["text"]).otherwise(F.get("__cut", i)).alias("answer"),
                        F.coalesce(F.nullif(F.get("__marks", i), F.lit(0)), F.when(F.col("__aligned"), block["marks"])).alias("marks"), F.lit("part").alias("split"))

    one = F.struct(F.lit(None).cast("string").alias("part"), F.lit("").alias("stem"), F.lit("").alias("part_stem"), F.col(text).alias("own"), F.array_join(F.transform("__b", lambda b: b["text"]), "\n\n").alias("answer"),
                   F.coalesce(F.nullif(F.col("__all"), F.lit(0)), F.when(F.size("__b") == 1, F.get("__b", F.lit(0))["marks"]), F.col(stated).cast("long")).alias("marks"), F.when(F.size("__l.parts") > 0, "whole").otherwise("single").alias("split"))
    units = F.when(F.col("__aligned") | F.col("__cut").isNotNull(), F.transform("__l.parts", unit)).otherwise(F.array(one))
    return x.select(*kept, F.posexplode(units).alias("nth", "u")).select(*kept, "nth", "u.*")
