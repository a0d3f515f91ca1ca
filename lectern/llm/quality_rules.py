"""Quality rules: base counts of a text, and the divergence of its histograms from those of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import ascii_words, durable

SYMBOLS = "#*$%&|<>"
#: Character classes, in this order; a character of none of them is "other".
CLASSES = ("[a-zß-öø-ÿ]", "[A-ZÀ-ÖØ-Þ]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?'\"()\-]", f"[{SYMBOLS.replace('*', chr(92) + '*').replace('$', chr(92) + '$').replace('|', chr(92) + '|')}]")
#: Frequent function words of each language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "on", "are", "by", "this", "be", "from", "or", "an"),
    "de": ("der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "des", "dem", "nicht", "ein", "eine", "als", "auf", "sich", "im", "auch"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "dans", "qui", "par", "pour", "sur", "est", "pas", "au", "plus"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "las", "un", "por", "con", "una", "no", "se", "su", "para", "es", "al"),
}
#: Guards: shorter texts are not judged by that histogram.
MIN_CHARS, MIN_WORDS = 200, 80
#: Largest Jensen-Shannon distance (square root of the divergence to base 2, 0 to 1) of character classes that is kept.
MAX_CLASS_DISTANCE = 0.30
#: The distance of common words falls with the square root of a text's words. Kept is what lies within WORD_SPREAD times the middle one of its language at that length, and WORD_SLACK; but never more than WORD_MOST of the distance
#: of a text without any common word.
WORD_SPREAD, WORD_SLACK, WORD_MOST = 1.6, 0.08, 0.9
#: Steps of 1 in which distances times the square root of words are counted, to find the middle one.
SCALE_STEPS = 100


def covered_by_repeats(words: Column) -> Column:
    """How many words lie in three-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes of their words, sorted with their places; neighbours that are equal mark both places, and the marked places in order give the words they cover.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def marked(w: Column) -> Column:
        """(place, hash) of windows whose hash is that of a neighbour in sorted order."""
        same = F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: a["h"] == b["h"])  # the last has no right neighbour: null
        flags = F.zip_with(same, F.concat(F.array(F.lit(False)), same), lambda right, left: F.coalesce(right, F.lit(False)) | F.coalesce(left, F.lit(False)))
        return F.transform(F.filter(F.arrays_zip(w.alias("w"), flags.alias("f")), lambda x: x["f"]), lambda x: x["w"]["at"])

    def covered(places: Column) -> Column:
        gaps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    def of(h: Column) -> Column:
        distinct = F.size(F.array_distinct(h)) == F.size(h)
        placed = F.transform(h, lambda x, at: F.struct(x.alias("h"), at.alias("at")))
        return F.when(distinct, F.lit(0).cast("long")).otherwise(let(F.sort_array(placed), lambda s: let(F.sort_array(marked(s)), covered)))

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(hashes, of))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: a one-element array is transformed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def base_counts(text: Column) -> Column:
    """struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            covered_by_repeats(w).alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dups = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    w = let(ascii_words(text), of_words)
    return let(
        w,
        lambda c: F.struct(
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            (F.char_length(text) - F.char_length(F.regexp_replace(text, CLASSES[5], ""))).cast("long").alias("n_symbols"),
            dups.alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def class_histogram(text: Column) -> Column:
    """Counts of each character class and of the rest: each class is taken out of what the earlier ones left."""
    out, rest = [], F.coalesce(text, F.lit(""))
    left = F.char_length(rest)
    for c in CLASSES:
        rest = F.regexp_replace(rest, f"{c}+", "")
        now = F.char_length(rest)
        out.append((left - now).cast("long"))
        left = now
    return F.array(*out, left.cast("long"))


def word_histogram(text: Column, lang: Column) -> Column:
    """Counts of the language's common words, then of all other words; of a language without a list only the latter.

    Every word gets a space of its own on both sides. The listed ones are taken out first and then counted in the little that they are.
    """
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D.,;:!?'\"()]+", "  "), F.lit(" "))

    def of(p: Column) -> Column:
        listed, left = F.array().cast("array<string>"), F.lit("")
        for name, words in COMMON_WORDS.items():
            listed = F.when(lang == name, F.array(*(F.lit(f" {w} ") for w in words))).otherwise(listed)
            left = F.when(lang == name, F.array_join(F.regexp_extract_all(p, F.lit(f"( (?:{'|'.join(words)}) )"), F.lit(1)), "")).otherwise(left)
        trimmed = F.trim(p)
        total = F.when(trimmed == "", 0).otherwise(1 + F.octet_length(trimmed) - F.octet_length(F.replace(trimmed, F.lit("  "), F.lit(" "))))
        counts = let(left, lambda r: F.transform(listed, lambda w: ((F.octet_length(r) - F.octet_length(F.replace(r, w, F.lit("")))) / F.octet_length(w)).cast("long")))
        return let(counts, lambda c: F.concat(c, F.array(F.greatest(F.lit(0), total - F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)))))

    return let(padded, of)


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance to base 2 between two histograms of one length; null if either is empty."""

    def share(a: Column) -> Column:
        return let(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), lambda n: F.transform(a, lambda x: x / n))

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(share(counts), share(reference), lambda x, y: (part(x, y) + part(y, x)) / 2)
    d = F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))))
    full = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x) > 0
    return F.when(full(counts) & full(reference), d)


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """doc_id, lang, n_chars, the base counts, both histograms and base_failed of each row."""
    text, lang = F.col(text_col), F.col(lang_col)
    cols = [F.col(id_col).alias("doc_id"), lang.alias("lang"), F.char_length(F.coalesce(text, F.lit(""))).alias("n_chars"), base_counts(text).alias("b"), class_histogram(text).alias("classes"), word_histogram(text, lang).alias("words")]
    rows = docs.select(*cols).select("doc_id", "lang", "n_chars", "b.*", "classes", "words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def by_words(min_words: int) -> Column:
    """The distance of common words from ref_words; null where a guard or an empty histogram leaves a text unjudged."""
    return F.when((F.col("n_words") >= min_words) & (F.size("words") > 1), js_distance(F.col("words"), F.col("ref_words")))


def pooled(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """ref_lang, ref_classes, ref_words, word_scale: for each language the summed histograms of the measured rows that pass the base rules, and the middle one of their distances of common words times the square root of their words.

    The middle one is read from counts by steps, so no language's rows are sorted; it does not depend on how rows are dealt. It is null where no row is long enough."""
    sums = lambda c, n: F.array(*(F.sum(F.get(c, k)) for k in range(n)))
    most = max(map(len, COMMON_WORDS.values())) + 1
    sound = rows.where(~F.col("base_failed"))
    refs = sound.groupBy(F.col("lang").alias("ref_lang")).agg(sums("classes", len(CLASSES) + 1).alias("ref_classes"), sums("words", most).alias("ref_words"))
    refs = durable(refs.withColumn("ref_words", F.filter("ref_words", lambda x: x.isNotNull())))
    near = sound.join(refs.select("ref_lang", "ref_words"), F.col("lang").eqNullSafe(F.col("ref_lang"))).withColumn("d", by_words(min_words)).where("d is not null")
    steps = near.groupBy(F.struct("ref_lang").alias("of"), F.floor(F.col("d") * F.sqrt("n_words") * SCALE_STEPS).alias("step")).agg(F.count(F.lit(1)).alias("c"))
    so_far = F.sum("c").over(Window.partitionBy("of").orderBy("step"))
    steps = steps.select("of", "step", so_far.alias("so_far"), F.sum("c").over(Window.partitionBy("of")).alias("all"))
    middle = steps.where(2 * F.col("so_far") >= F.col("all")).groupBy("of").agg(((F.min("step") + 1) / SCALE_STEPS).alias("word_scale"))
    return refs.join(middle, F.struct("ref_lang") == F.col("of"), "left").drop("of")


def word_limit(spread: float, slack: float, most: float) -> Column:
    """The largest kept distance of common words for a text of n_words, by the references joined to it."""
    none = F.transform("ref_words", lambda x, i: (i == F.size("ref_words") - 1).cast("long"))
    cap = most * js_distance(none, F.col("ref_words"))
    return F.least(cap, slack + spread * F.col("word_scale") / F.sqrt(F.greatest("n_words", F.lit(1))))  # least passes over a null scale


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """References to write once, from a corpus that is trusted, and to judge other documents by: one row per language with a sound document (null is one), as verdicts takes them. No sound documents give no rows."""
    return pooled(durable(measured(docs, text_col, text_col, lang_col).drop("doc_id")))


def verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    word_spread: float = WORD_SPREAD,
    word_slack: float = WORD_SLACK,
    word_most: float = WORD_MOST,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    references: DataFrame | None = None,
) -> DataFrame:
    """One row per row of docs: doc_id, the base counts, base_failed, kept, the two distances (null where a guard or an empty histogram leaves a text unjudged) and word_limit.

    A text is rejected if its character classes are too far from those of its language, or its common words farther than word_limit, be they too many or too few: the limit is learned from the sound documents of the language, falls with a
    text's length, and never reaches the distance of a text without common words.

    references: those that language_references learned from another corpus; a verdict then depends on the document alone, and a language without one is judged by the base rules only. None: the pooled histograms of all
    documents of docs that pass the base rules, so no table is needed. Null text is empty (base_failed by its length);
    a null or unknown language has a class reference of its own and no word list, so no word distance. Null ids and repeated rows stay; other columns are not read; no rows give none.
    """
    rows = durable(measured(docs, id_col, text_col, lang_col))
    refs = pooled(rows, min_words) if references is None else references.select("ref_lang", "ref_classes", "ref_words", "word_scale")
    judged = rows.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    by_class = F.when(F.col("n_chars") >= min_chars, js_distance(F.col("classes"), F.col("ref_classes")))
    judged = judged.withColumns({"class_distance": by_class, "word_distance": by_words(min_words), "word_limit": word_limit(word_spread, word_slack, word_most)})
    fine = (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) & F.coalesce(F.col("word_distance") <= F.col("word_limit"), F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & fine).alias("kept"), "class_distance", "word_distance", "word_limit")
