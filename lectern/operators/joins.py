"""Joins of units with tags, names, quotes, files and calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.text import quote_norm

#: A side is broadcast only if it has so many rows and bytes of text at most; it is counted first.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
#: Characters of the piece by which a short needle is looked up, at most.
PIECE = 4


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if a count, cut off above the bound of rows, shows that it and its texts are small; else as it is."""
    texts = [F.octet_length(c) for c, kind in df.dtypes if kind in ("string", "binary")]
    n, held = df.limit(rows + 1).select(sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0)).cast("long").alias("b")).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= size else df


def inherited_tags(units: DataFrame, tags: DataFrame) -> DataFrame:
    """units (id, dupe_of) with tags (id, tags): their own, or those of what they are a copy of. An empty list counts as none."""
    own = tags.select("id", F.col("tags").alias("own"))
    keeper = tags.select(F.col("id").alias("dupe_of"), F.col("tags").alias("kept"))
    full = lambda c: F.when(F.size(c) > 0, F.col(c))
    return units.join(own, "id", "left").join(keeper, "dupe_of", "left").withColumn("tags", F.coalesce(full("own"), full("kept"))).drop("own", "kept")


def untagged(units: DataFrame, tags: DataFrame) -> DataFrame:
    return units.join(tags.where(F.size("tags") > 0), "id", "left_anti")


def invalid_tags(tags: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """id, tag: tags that the taxonomy (column tag) lacks."""
    return tags.select("id", F.explode("tags").alias("tag")).join(taxonomy, "tag", "left_anti").select("id", "tag")


def named(rows: DataFrame, names: DataFrame, key: str, out: str = "name") -> DataFrame:
    """rows with the name of a key (names: key, name), or the key itself."""
    n = names.select(F.col(key), F.col("name").alias("__name"))
    return rows.join(n, key, "left").withColumn(out, F.coalesce("__name", F.col(key).cast("string"))).drop("__name")


def verified_quotes(quotes: DataFrame, pages: DataFrame) -> DataFrame:
    """quote_id, doc, page: the first page of its document that has the quote, or on which it begins to run over to the next; null if none. quotes: quote_id, doc, quote; pages: doc, page, text.

    Compared without spaces and dots in normal form. Quotes meet only the pages of their own document.
    """
    bare = lambda c: F.translate(quote_norm(c), " .", "")
    p = pages.select("doc", "page", bare(F.col("text")).alias("t"))
    p = p.withColumn("two", F.concat("t", F.coalesce(F.lead("t").over(Window.partitionBy("doc").orderBy("page")), F.lit(""))))
    q = quotes.select("quote_id", "doc", bare(F.col("quote")).alias("q"))
    hit = q.join(p, "doc").where(F.contains("two", "q")).groupBy("quote_id", "doc").agg(F.coalesce(F.min(F.when(F.contains("t", "q"), F.col("page"))), F.min("page")).alias("page"))
    return q.select("quote_id", "doc").join(hit, ["quote_id", "doc"], "left")


def contained(needles: DataFrame, texts: DataFrame, ident: str, needle: str = "needle", text: str = "text") -> DataFrame:
    """Pairs of needle and text rows where the text holds the needle; both are single-spaced. ident: a key of texts.

    The second to fourth word of a needle of five or more are whole words of any text that holds it, so such needles meet only texts with these three words in a row. A shorter needle is looked up by the PIECE characters that it begins with (all of
    them, if it has fewer), among the pieces of each text. Keys and idents are joined first, and the texts of the pairs so found are fetched once. Empty and null needles are in no text.
    """
    words = lambda c: F.split(c, " ")
    three = lambda w, i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    keyed = needles.where(F.length(needle) > 0).withColumn("__w", words(F.col(needle)))
    long = keyed.where(F.size("__w") >= 5).withColumn("__key", three(F.col("__w"), F.lit(1))).drop("__w")
    w = texts.select(ident, words(F.col(text)).alias("__w")).where(F.size("__w") >= 3)
    probes = w.select(ident, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: three(F.col("__w"), i)))).alias("__key"))
    found = [probes.join(small(long), "__key").drop("__key")]
    short = keyed.where(F.size("__w") < 5).drop("__w").withColumn("__n", F.least(F.length(needle), F.lit(PIECE)))
    for (n,) in short.select("__n").distinct().orderBy("__n").collect():  # PIECE numbers at most
        own = short.where(F.col("__n") == n).withColumn("__key", F.substring(needle, 1, n)).drop("__n")
        letters = texts.select(ident, F.split(text, "").alias("__c")).where(F.size("__c") >= n)
        pieces = F.transform(F.sequence(F.lit(0), F.size("__c") - n), lambda i: F.concat(*(F.get("__c", i + k) for k in range(n))))  # noqa: B023
        found.append(letters.select(ident, F.explode(F.array_distinct(pieces)).alias("__key")).join(small(own), "__key").drop("__key"))
    return reduce(DataFrame.unionByName, found).join(texts, ident).where(F.contains(text, needle))


def first_alias(wanted: DataFrame, aliases: DataFrame, present: DataFrame) -> DataFrame:
    """wanted (id) with the directory of least priority among its aliases (id, dir, priority) that is present (dir), or null."""
    there = aliases.join(present, "dir", "left_semi")
    return wanted.join(there.groupBy("id").agg(F.min_by("dir", "priority").alias("dir")), "id", "left")


def shared_claims(claims: DataFrame, key: list[str], owner: str) -> DataFrame:
    """Each claim with the other owners of its key, sorted."""
    every = claims.groupBy(*key).agg(F.array_sort(F.collect_set(owner)).alias("also"))
    return claims.select(*key, owner).distinct().join(every, key).withColumn("also", F.array_except("also", F.array(owner)))


def calendar_gaps(sessions: DataFrame) -> DataFrame:
    """year, season: what the grid of years and observed seasons lacks between the first and the last session. sessions: year, season."""
    s = sessions.distinct()
    ends = s.agg(F.min(F.struct("year", "season")).alias("a"), F.max(F.struct("year", "season")).alias("b"))
    grid = ends.select("a", "b", F.explode(F.sequence("a.year", "b.year")).alias("year")).join(F.broadcast(s.select("season").distinct()))
    inside = grid.where((F.struct("year", "season") > F.col("a")) & (F.struct("year", "season") < F.col("b")))
    return inside.select("year", "season").join(s, ["year", "season"], "left_anti")


def twins(parts: DataFrame) -> DataFrame:
    """sitting, a, b, copied, parts, twin: for each two variants a < b of a sitting how many parts of b have a text of a, and whether that is half or more. parts: sitting, variant, text."""
    v = parts.groupBy("sitting", "variant").agg(F.count(F.lit(1)).alias("parts"))
    pairs = v.alias("x").join(v.alias("y"), "sitting").where(F.col("x.variant") < F.col("y.variant")).select("sitting", F.col("x.variant").alias("a"), F.col("y.variant").alias("b"), F.col("y.parts").alias("parts"))
    texts = parts.select("sitting", "variant", "text").distinct()
    n = parts.groupBy("sitting", "variant", "text").agg(F.count(F.lit(1)).alias("n"))
    both = texts.withColumnRenamed("variant", "a").join(n.withColumnRenamed("variant", "b"), ["sitting", "text"]).where("a < b").groupBy("sitting", "a", "b").agg(F.sum("n").alias("copied"))
    j = pairs.join(both, ["sitting", "a", "b"], "left").withColumn("copied", F.coalesce("copied", F.lit(0)))
    return j.withColumn("twin", 2 * F.col("copied") >= F.col("parts"))


def not_shipped(wanted: DataFrame, shipped: DataFrame) -> DataFrame:
    """wanted (id, name) without a shipped name (id, have) that equals it or ends with it, whatever the case; compared within one id."""
    w = wanted.select("id", "name", F.lower("name").alias("n"))
    h = shipped.select("id", F.lower("have").alias("h"))
    return w.join(h, (w.id == h.id) & F.endswith(F.col("h"), F.col("n")), "left_anti").select("id", "name")


def with_default(rows: DataFrame, lookup: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """rows with a lookup's columns, or the defaults where a key isn't in it."""
    j = rows.join(lookup, key, "left")
    return j.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
