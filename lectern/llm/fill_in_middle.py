"""Fill-in-the-middle: texts cut at units into prefix, middle and suffix, and written in another order."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import free_name

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that are put into another order, and of these the percent in the order suffix, prefix, middle.
FIM_PERCENT, SPM_PERCENT = 90, 20


@dataclass(frozen=True)
class Units:
    """A grammar of units. runs: bodies of character classes, such as `A-Za-z`, no character in two of them; a unit is a longest run of one class, or else one character that is in none."""

    runs: tuple[str, ...]

    def tokens(self) -> str:
        """The pattern of a unit."""
        return "|".join([*(f"[{c}]+" for c in self.runs), f"[^{''.join(self.runs)}]" if self.runs else r"[\s\S]"])

    def boundary(self) -> str:
        """The zero-width pattern of the places between two units: for each class, the character before or the one after is not in it. Ends of the text, and the middle of a character of two code units, are no such places."""
        inside = "".join(f"(?:(?<![{c}])|(?![{c}]))" for c in self.runs)
        return rf"(?<=[\s\S])(?=[\s\S])(?<![\x{{D800}}-\x{{DBFF}}]){inside}"


#: Words of ASCII letters, and any other character alone.
LETTERS = Units(("A-Za-z",))
#: Letters, digits and blanks each in runs.
WORDS = Units(("A-Za-z", "0-9", " \t\n"))


def units(text: Column, grammar: Units = LETTERS) -> Column:
    """The units of a text, in order; null and empty texts have none (a split of them would give one empty piece)."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, grammar.boundary(), -1))


def draw(ident: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of an id: the first digit groups of the SHA-256 of `1:` and the id as text (null: nothing)."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def joined(form: Column, prefix: Column, middle: Column, suffix: Column, text: Column) -> Column:
    """The text in its form: psm, spm, or plain as it was."""
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, by its marks alone. The parts hold no mark, so the first of each is the one that was put there."""
    one, two = F.when(form == "spm", PREFIX).otherwise(SUFFIX), F.lit(MIDDLE)
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    cut = F.instr(body, one)
    first, rest = F.substr(body, F.lit(1), cut - 1), F.substr(body, cut + 3)
    cut = F.instr(rest, two)
    second, middle = F.substr(rest, F.lit(1), cut - 1), F.substr(rest, cut + 3)
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grammar: Units = LETTERS, *, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """docs with n (units of the text), form (plain, psm or spm), prefix, middle, suffix (null if plain) and output.

    The two cuts, whether a text is changed and into which form depend on its id alone (see draw). Texts that are empty or hold one of the marks stay plain. A null text is empty; a null id is drawn as an empty one. Repeated rows
    fare alike. New columns replace none: clashing ones of docs are left out, but for the id. Each row is worked out where it is read, nothing is shuffled. No rows give none.
    """
    new = ("n", "form", "prefix", "middle", "suffix", "output")
    kept = [F.col(c) for c in docs.columns if c.lower() not in new]
    row = free_name(docs, "fim")
    h1, h2, h3, h4 = draw(F.col(id_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h3 % 100 >= fim_percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")

    def cut(u: Column) -> Column:
        n = F.size(u)
        a, b = (h1 % (n + 1)).cast("int"), (h2 % (n + 1)).cast("int")
        lo, hi = F.least(a, b), F.greatest(a, b)
        piece = lambda start, size: F.when(form != "plain", F.array_join(F.slice(u, start, size), ""))
        return F.struct(n.cast("long").alias("n"), piece(F.lit(1), lo).alias("prefix"), piece(lo + 1, hi - lo).alias("middle"), piece(hi + 1, n - hi).alias("suffix"))

    once = F.get(F.transform(F.array(units(text, grammar)), cut), F.lit(0))  # the units are made once
    rows = docs.withColumn(row, once).withColumn(f"{row}_form", form)
    parts = [F.col(f"{row}.{c}") for c in ("prefix", "middle", "suffix")]
    output = joined(F.col(f"{row}_form"), *parts, text)
    return rows.select(*kept, F.col(f"{row}.n").alias("n"), F.col(f"{row}_form").alias("form"), *(p.alias(c) for p, c in zip(parts, ("prefix", "middle", "suffix"))), output.alias("output"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grammar: Units = LETTERS) -> DataFrame:
    """doc_id, n, form, lengths of prefix and middle in code points, and the SHA-256 of the output and of the text restored from it."""
    t = transformed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")), "doc_id", "__text", grammar)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return t.select("doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"), sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def plain_units(text: str, grammar: Units = LETTERS) -> list[str]:
    """The units of one text by its grammar's token pattern, for tests."""
    return re.findall(grammar.tokens(), text)
