"""Column functions over text. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Typographic signs and their plain forms, one to one.
QUOTE_SIGNS = ("‘’“”–—−•", "''\"\"---*")
#: Signs that become several letters.
LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "..."))
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty")


def squeeze(c: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\x20\x09-\x0D]+", " "))


def alnum_norm(c: Column) -> Column:
    """Lower case; everything but ASCII letters and digits becomes one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def quote_norm(c: Column) -> Column:
    """The form in which quotes are compared: plain signs, single spaces, lower case."""
    plain = reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), LIGATURES, F.translate(c, *QUOTE_SIGNS))
    return F.lower(squeeze(plain))


def duplicate_norm(c: Column) -> Column:
    """The form in which units are compared for reprints: image links to IMG, paper codes and mark markers out, plain signs, dot runs out, single spaces, lower case."""
    out = F.regexp_replace(c, r"!\[[^\]]*\]\([^)]*\)", "IMG")
    out = F.regexp_replace(out, r"[0-9]{4}/[0-9]{2}[A-Za-z/0-9]*", " ")
    out = F.regexp_replace(out, r"\*\*\[[0-9]+\]\*\*|\[[0-9]+\]", " ")
    out = F.regexp_replace(F.translate(out, *QUOTE_SIGNS), r"\.{2,}", " ")
    return F.lower(squeeze(out))


def marks_in(c: Column) -> Column:
    """Sum of all printed `[n]`; null when there is none."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"\[([0-9]+)\]"), F.lit(1)), lambda x: x.cast("long"))
    return F.when(F.size(found) > 0, F.aggregate(found, F.lit(0).cast("long"), lambda s, x: s + x))


def first_of(c: Column, words: tuple[str, ...]) -> Column:
    """The first listed word, capital letter and all; else in any case, capitalised; else Other; null for empty text."""
    exact = F.regexp_extract(c, rf"(?U)\b({'|'.join(words)})\b", 1)
    loose = F.regexp_extract(F.lower(c), rf"(?U)\b({'|'.join(w.lower() for w in words)})\b", 1)
    return F.when(F.length(c) > 0, F.coalesce(F.nullif(exact, F.lit("")), F.when(loose != "", F.concat(F.upper(F.substring(loose, 1, 1)), F.substring(loose, 2, 1000))), F.lit("Other")))


def all_of(c: Column, words: tuple[str, ...]) -> Column:
    """Every listed word in the text, in order."""
    return F.regexp_extract_all(c, F.lit(rf"(?U)\b({'|'.join(words)})\b"), F.lit(1))


def bucket_key(c: Column, n: int = 3) -> Column:
    """The first n runs of ASCII letters, lower case."""
    return F.regexp_replace(F.regexp_extract(F.lower(c), f"[a-z]+([^a-z]+[a-z]+){{0,{n - 1}}}", 0), "[^a-z]+", " ")


def kept_lines(c: Column, junk: str) -> Column:
    """Lines without trailing spaces that don't match junk, blank runs collapsed to one."""
    lines = F.filter(F.transform(F.split(c, "\n", -1), lambda x: F.regexp_replace(x, r"[\x20\x09]+$", "")), lambda x: ~x.rlike(junk))
    return F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")


def stem(c: Column) -> Column:
    """What stands before the first mark marker, single-spaced, up to the end of its first sentence."""
    return F.regexp_extract(squeeze(F.substring_index(c, "**[", 1)), r"^([^.?]*[.?]?)", 1)


def truncated(c: Column, n: int, mark: str = "\n...") -> Column:
    """At most n characters, cut back to the last whole line, with a mark; shorter text as it is."""
    return F.when(F.char_length(c) <= n, c).otherwise(F.concat(F.regexp_replace(F.substring(c, 1, n), r"\n[^\n]*\z", ""), F.lit(mark)))


def clipped(c: Column, n: int) -> Column:
    """At most n characters, cut back to the last space, with an ellipsis; shorter text as it is."""
    return F.when(F.char_length(c) <= n, c).otherwise(F.concat(F.regexp_replace(F.substring(c, 1, n), r" [^ ]*\z", ""), F.lit("…")))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def safe_name(c: Column) -> Column:
    return F.translate(c, "/:", "--")


def number_word(c: Column) -> Column:
    """0 to 20 as a word, other numbers in digits."""
    return F.coalesce(F.get(F.array(*map(F.lit, NUMBER_WORDS)), c.cast("int")), c.cast("string"))


def listed(names: Column) -> Column:
    """a, b and c."""
    n = F.size(names)
    return F.when(n <= 1, F.array_join(names, "")).otherwise(F.concat(F.array_join(F.slice(names, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(names, -1)))


def minutes(c: Column) -> Column:
    """Minutes of a duration such as `1h 45m`."""
    part = lambda u: F.coalesce(F.nullif(F.regexp_extract(c, rf"([0-9]+) *{u}", 1), F.lit("")).cast("int"), F.lit(0))
    return part("h") * 60 + part("m")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; 0 where whole is null or 0."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(100.0 * part / whole)


def sittings_key(ts: Column) -> Column:
    """struct(year, season): 0 for January to April, 1 to August, 2 after; it orders by time."""
    m = F.month(ts)
    return F.struct(F.year(ts).alias("year"), F.when(m <= 4, 0).when(m <= 8, 1).otherwise(2).alias("season"))


def code_parts(code: Column) -> Column:
    """struct(session, year, variant, paper_no) of codes like 9626_s24_qp_02; null if malformed."""
    p = r"^[0-9]{4}_([msw])([0-9]{2})_[a-z]{2}_([0-9]{2})$"
    v = F.regexp_extract(code, p, 3)
    return F.when(code.rlike(p), F.struct(
        F.regexp_extract(code, p, 1).alias("session"),
        (F.regexp_extract(code, p, 2).cast("int") + 2000).alias("year"),
        v.alias("variant"),
        F.when(F.substring(v, 1, 1) == "0", F.substring(v, 2, 1)).otherwise(F.substring(v, 1, 1)).alias("paper_no"),
    ))


def html_text(c: Column) -> Column:
    """Text of an HTML page: scripts, styles and comments out, block ends to line breaks, other tags out, the common entities decoded."""
    out = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)</(p|div|li|h[1-6]|tr)>|<br>", "\n")
    out = F.regexp_replace(out, "<[^>]*>", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[\x20\x09]+", " "), r" ?\n[\x20\n]*", "\n"))
