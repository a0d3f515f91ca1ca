"""Column functions over the text of papers, mark schemes and reports. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import squeeze

# The three vocabularies of command words. A longer word goes before one that begins it.
ALL_MATCHES = ("Analyse", "Compare and contrast", "Compare", "Contrast", "Define", "Describe", "Discuss", "Evaluate", "Explain", "Identify", "Justify", "State", "Suggest", "Choose", "Complete", "Draw", "Give")
FIRST_MATCH = ("Analyse", "Compare and contrast", "Compare", "Contrast", "Define", "Describe", "Discuss", "Evaluate", "Explain", "Identify", "Justify", "State", "Suggest", "Choose", "Complete", "Draw", "Give", "Assess")
LAST_MATCH = ("Compare and contrast", "Analyse", "Assess", "Compare", "Contrast", "Define", "Describe", "Discuss", "Evaluate", "Explain", "Identify", "Justify", "State", "Suggest", "Give", "Complete", "Draw", "Write", "Calculate", "Name", "List")
# Lines that extraction leaves behind, and phrases of legal notices.
JUNK_LINE = r"^[ \t]*([0-9]{4}/[0-9]{2}/[A-Z](/[A-Z])*/[0-9]{2}|©[ \t]*UCLES[ \t]*[0-9]{4}|\[?Turn over\]?|BLANK PAGE|DC[ \t]*\([A-Z]+\)[ \t]*[0-9]+.*|\*[ \t]*[0-9]{6,}[ \t]*\*|(DO NOT WRITE IN THIS MARGIN[ \t]*)+|DFD|[^\x00-\x7F \t]{6,}|[0-9]{1,3}|[,\x00-\x20]+|www\.dynamicpapers\.com)[ \t]*$"
NOTICES = ("Permission to reproduce items", "reasonable effort has been made by the publisher", "copyright acknowledgements", "Local Examinations Syndicate", "Cambridge Assessment is the brand name")
ANSWER_LINE = r"^[ \t]*([0-9]+[.)]|\([A-Za-z0-9_]+\)|[-•])?[ \t]*\.{4,}[ \t.]*(\*\*\[[0-9]+\]\*\*)?[ \t]*$"
LEAD_IN = "(?i)^(You may refer|Refer to|Read |Look at|Use the insert)"
BOILER_PART = "(?i)^(Save your|Save this|Save the|Put your|Place your|Make sure|All tasks)"
SESSIONS = {"m": "March", "s": "June", "w": "November"}
#: Signs of the Symbol font: bullet, times, space.
BULLET, TIMES, SPACE = "\uf0b7", "\uf0b4", "\uf020"
ENDINGS = "csv|rtf|html|png|txt"


def lines_of(c: Column) -> Column:
    return F.split(c, "\n", -1)


def bank_clean(c: Column) -> Column:
    """A question's text without junk: blank answer lines go but for the mark at their end, junk lines and notices go, dot leaders at a line's end go, blank runs collapse, none at the ends."""
    def line(x: Column) -> Column:
        mark = F.regexp_extract(x, ANSWER_LINE, 2)
        notice = F.lit(False)
        for n in NOTICES:
            notice = notice | F.contains(x, F.lit(n))
        return F.when(x.rlike(ANSWER_LINE), F.nullif(mark, F.lit(""))).when(x.rlike(JUNK_LINE) | notice, None).otherwise(F.regexp_replace(x, r"[ \t]*\.{6,}[ \t]*$", ""))

    kept = F.array_join(F.filter(F.transform(lines_of(c), line), lambda x: x.isNotNull()), "\n")
    return F.regexp_replace(F.regexp_replace(F.replace(kept, F.lit("«"), F.lit("...")), r"\n{3,}", "\n\n"), r"^[ \t\n]+|[ \t\n]+$", "")


def noise(text: Column, height: Column, bottom: Column, page_height: Column) -> Column:
    """A tiny line without letters or digits, or a footer in the lowest 60 points."""
    # What page footers hold.
    footer = text.rlike(r"(?i)UCLES|Turn over|^DC \([A-Z]+\)|[0-9]{4}/[0-9]{2}/ *[A-Z] */ *[A-Z] */ *[0-9]{2}")
    return ((height < 7) & ~text.rlike("[A-Za-z0-9]")) | ((bottom > page_height - 60) & footer)


def joined(*parts: Column, sep: str = "\n") -> Column:
    """The parts that aren't null or empty."""
    return F.concat_ws(sep, *(F.nullif(p, F.lit("")) for p in parts))


def sentences(c: Column) -> Column:
    """Sentences of a single-spaced text: cut after a full stop or question mark and a space."""
    return F.split(F.regexp_replace(squeeze(c), r"([.?]) ", "$1\u0001"), "\u0001")


def wording(c: Column, lead_in: str = LEAD_IN, boiler: str = BOILER_PART, least: int = 5) -> Column:
    """A part's own wording: sentences that lead in are left out; null for boilerplate and for fewer words than least."""
    own = F.array_join(F.filter(sentences(c), lambda s: (s != "") & ~s.rlike(lead_in)), " ")
    return F.when((F.size(F.split(own, " ")) >= least) & ~own.rlike(boiler), own)


def matches(words: tuple[str, ...]) -> str:
    return rf"(?U)\b({'|'.join(words)})\b"


def command_words(c: Column) -> Column:
    """Every command word of a stem, in order."""
    return F.regexp_extract_all(c, F.lit(matches(ALL_MATCHES)), F.lit(1))


def first_command(c: Column) -> Column:
    """The first command word, a capitalised match first, then any case; Other if none; null for an empty text."""
    exact, loose = F.regexp_extract(c, matches(FIRST_MATCH), 1), F.lower(F.regexp_extract(c, f"(?i){matches(FIRST_MATCH)}", 1))
    up = F.concat(F.upper(F.substring(loose, 1, 1)), F.substring(loose, 2, 99))
    return F.when(F.length(c) > 0, F.coalesce(F.nullif(exact, F.lit("")), F.nullif(up, F.lit("")), F.lit("Other")))


def last_command(c: Column) -> Column:
    """The last command word that opens a sentence, else the last capitalised, else the last in any case; null if none. In capitals, but for `and`."""
    own = F.regexp_replace(c, r"\[[0-9]+\]", "")
    opens = F.regexp_extract_all(own, F.lit(rf"(?:^|[.?)\]][ \n\t])({'|'.join(LAST_MATCH)})\b"), F.lit(1))
    exact = F.regexp_extract_all(own, F.lit(matches(LAST_MATCH)), F.lit(1))
    loose = F.regexp_extract_all(own, F.lit(f"(?i){matches(LAST_MATCH)}"), F.lit(1))
    last = lambda a: F.get(a, F.size(a) - 1)
    hit = F.coalesce(last(opens), last(exact), last(loose))
    return F.replace(F.initcap(F.lower(hit)), F.lit(" And "), F.lit(" and "))


def names_saved(c: Column) -> Column:
    """Lower-case names that a text says to save as. The words that say so are fixed values."""
    found = F.regexp_extract_all(c, F.lit(rf"(?iU)(?:save|saved|saving|store)\b[^.]{{0,80}}?\bas\s+(?:a\s+\w+\s+)?([A-Za-z0-9][\w.\-]{{0,40}}?\.(?:{ENDINGS}))"), F.lit(1))
    return F.transform(found, F.lower)


def file_names(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"([A-Za-z0-9][A-Za-z0-9_.\-]*\.(?:{ENDINGS}))"), F.lit(1)))


def names_file(text: Column, stem: Column, ending: Column) -> Column:
    """Whether a text names a file: in full, in any case and with breaks around the dot; or by its bare stem as a whole word, if that is distinctive (five signs or more, with a digit, an underscore or a hump)."""
    full = F.regexp_like(text, F.concat(F.lit("(?iU)"), stem, F.lit(r"\s*\.?\s*"), ending, F.lit(r"\b")))
    bare = (F.length(stem) >= 5) & stem.rlike("[_0-9]|[a-z][A-Z]") & F.regexp_like(text, F.concat(F.lit(r"(?U)(^|[^\w.])"), stem, F.lit(r"($|[^\w.])")))
    return full | bare


def report_comment(section: Column, q: Column, part: Column) -> Column:
    """struct(text, scope) of what a report's section says on a question: what stands under its part's letter, if that is over 40 characters, else all on the question; null if it isn't mentioned."""
    pieces = F.filter(F.split(F.regexp_replace(section, "Question ([0-9])", "\u0001$1"), "\u0001"), lambda p: F.regexp_like(p, F.concat(F.lit("^"), q, F.lit("([^0-9]|$)"))))
    body = F.trim(F.substring(F.get(pieces, F.lit(0)), F.length(q) + 1, F.lit(1 << 30)))
    own = F.trim(F.call_function("regexp_extract", body, F.concat(F.lit(r"(?s)\("), part, F.lit(r"\)(.*?)(\([a-h]\) |$)")), F.lit(1)))
    narrow = part.isNotNull() & (F.length(own) > 40)
    return F.when(body.isNotNull(), F.struct(F.when(narrow, own).otherwise(body).alias("text"), F.when(narrow, "part").otherwise("question").alias("scope")))


def scheme_text(c: Column) -> Column:
    """A mark scheme's text: Symbol signs to plain ones, bullets to dashes, lines trimmed, blank ones out."""
    plain = F.replace(F.replace(c, F.lit(TIMES), F.lit("×")), F.lit(SPACE), F.lit(" "))
    lines = F.filter(F.transform(lines_of(plain), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.transform(lines, lambda x: F.when(F.startswith(x, F.lit(BULLET)), F.concat(F.lit("- "), F.trim(F.substring(x, 2, 1 << 30)))).otherwise(x)), "\n")


def scheme_row(cells: Column) -> Column:
    """A row of a mark scheme's table: its cells, and the last one as marks if it is a number."""
    last = F.trim(F.element_at(cells, -1))
    marked = last.rlike("^[0-9]+$")
    body = F.when(marked, F.slice(cells, F.lit(1), F.size(cells) - 1)).otherwise(cells)
    text = scheme_text(F.array_join(body, "\n\n"))
    return F.when(F.size(cells) == 0, "").when(marked, F.concat(text, F.lit("\n\n**Marks: "), last, F.lit("**"))).otherwise(text)


def question_body(c: Column) -> Column:
    """Marks at a line's end in bold; roman sub-parts indented as list items, letters as list items."""
    def line(x: Column) -> Column:
        bold = F.regexp_replace(x, r"[ \t]*\[([0-9]+)\][ \t]*$", " **[$1]**")
        return F.regexp_replace(F.regexp_replace(bold, r"^\((i{1,3}|iv|v|vi{1,3})\)", "  - ($1)"), r"^\(([a-h])\)", "- ($1)")

    return F.array_join(F.transform(lines_of(c), line), "\n")


def table_cell(c: Column) -> Column:
    """Text for a cell of a Markdown table: paragraphs and lines by breaks, pipes escaped, number words before `marks` in bold."""
    out = F.replace(F.trim(c), F.lit("|"), F.lit("\\|"))
    out = F.regexp_replace(F.regexp_replace(out, r"\n[ \t]*\n[\s]*", "<br><br>"), r"\n", "<br>")
    return F.regexp_replace(out, r"(?U)\b(one|two|three|four|five|six) (marks?)\b", "**$1** $2")


def moved_to_end(c: Column, block: str) -> Column:
    """Paragraphs that begin with a pattern go to the end, in their order; doing it twice is as once."""
    paragraphs = F.split(c, "\n\n", -1)
    return F.array_join(F.concat(F.filter(paragraphs, lambda p: ~p.rlike(block)), F.filter(paragraphs, lambda p: p.rlike(block))), "\n\n")


def session_sort(code: Column) -> Column:
    """struct(year, season) of codes such as s24, in the order of time."""
    return F.struct((2000 + F.substring(code, 2, 2).cast("int")).alias("year"), (F.instr(F.lit("msw"), F.substring(code, 1, 1)) - 1).alias("season"))


def question_sort(q: Column) -> Column:
    """struct(number, part) of questions such as 10b."""
    return F.struct(F.coalesce(F.nullif(F.regexp_extract(q, "^([0-9]+)", 1), F.lit("")).cast("int"), F.lit(0)).alias("number"), F.regexp_replace(q, "^[0-9]+", "").alias("part"))


def session_name(code: Column) -> Column:
    """`s24` to `June 2024`; other text as it is."""
    month = F.create_map(*(F.lit(x) for kv in SESSIONS.items() for x in kv))[F.substring(code, 1, 1)]
    return F.when(code.rlike("^[msw][0-9]{2}$"), F.concat(month, F.lit(" 20"), F.substring(code, 2, 2))).otherwise(code)


def html_escaped(c: Column) -> Column:
    out = c
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def citation(doc: Column, page: Column) -> Column:
    """`document s24, page 3` as `June 2024, page 3`; an error if the page isn't known."""
    checked = F.coalesce(page.cast("string"), F.raise_error(F.concat(F.lit("not verified: "), doc)).cast("string"))
    return F.concat(session_name(doc), F.lit(", page "), checked)


def year_runs(years: Column) -> Column:
    """Sorted distinct years as runs: `2019-2021, 2023`."""
    ys = F.array_sort(F.array_distinct(years))
    starts = F.filter(ys, lambda y: ~F.array_contains(ys, y - 1))
    ends = F.filter(ys, lambda y: ~F.array_contains(ys, y + 1))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat(a.cast("string"), F.lit("-"), b.cast("string")))), ", ")


def filled(template: str, fields: dict[str, Column]) -> Column:
    """A template with `{field}` replaced. A field that isn't known, or a brace left, is an error at once."""
    import re

    parts = re.split(r"\{([a-z_]+)\}", template)
    if unknown := [p for p in parts[1::2] if p not in fields]:
        raise ValueError(f"unknown fields: {unknown}")
    if any(s in p for p in parts[::2] for s in "{}"):
        raise ValueError("a brace is left")
    return F.concat(*(fields[p].cast("string") if k % 2 else F.lit(p) for k, p in enumerate(parts)))


def markdown_html(c: Column) -> Column:
    """Markdown as HTML: headings, list items, bold, paragraphs; text is escaped first. Post-rules: items that follow each other share a list, and blank lines go."""
    def line(x: Column) -> Column:
        e = F.regexp_replace(html_escaped(x), r"\*\*([^*]+)\*\*", "<b>$1</b>")
        level = F.length(F.regexp_extract(x, "^(#{1,6}) ", 1)).cast("string")
        heading = F.concat(F.lit("<h"), level, F.lit(">"), F.regexp_replace(e, "^#{1,6} ", ""), F.lit("</h"), level, F.lit(">"))
        item = F.concat(F.lit("<ul><li>"), F.substring(e, 3, 1 << 30), F.lit("</li></ul>"))
        return F.when(x.rlike("^#{1,6} "), heading).when(F.startswith(x, F.lit("- ")), item).otherwise(F.concat(F.lit("<p>"), e, F.lit("</p>")))

    lines = F.transform(F.filter(lines_of(c), lambda x: F.trim(x) != ""), line)
    return F.replace(F.array_join(lines, "\n"), F.lit("</ul>\n<ul>"), F.lit("\n"))
