"""Notes in Markdown as HTML with a table of contents. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.papers import html_escaped, lines_of
from lectern.functions.text import slug

# The tiers of a priority label, and the cells from which a table is shown as cards.
TIERS = "HIGH|MEDIUM|LOW"
CARD_COLUMNS, CARD_CHARS = 3, 60
PRIORITY = rf"^\*Priority: ({TIERS})\.[ \t]*(.*)\*$"
TIP = r"^(?:\*\*)?Exam tip:?(?:\*\*)?:?[ \t]*"
SEPARATOR = r"^\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?$"


def let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def inline(c: Column) -> Column:
    """Text within a line: escaped, code (which may break after a comma), bold, emphasis."""
    marked = lambda x: F.regexp_replace(F.regexp_replace(x, r"\*\*([^*]+)\*\*", "<strong>$1</strong>"), r"\*([^*]+)\*", "<em>$1</em>")

    def of(code: Column, closed: Column) -> Column:
        part = lambda x, i: F.when((i % 2 == 1) & (i < closed), F.concat(F.lit("<code>"), F.replace(x, F.lit(","), F.lit(",<wbr>")), F.lit("</code>"))).when(i >= closed, F.concat(F.lit("`"), marked(x))).otherwise(marked(x))
        return F.array_join(F.transform(code, part), "")

    # an odd tick at the end opens nothing
    return let(F.split(html_escaped(c), "`", -1), lambda code: let(F.size(code) - (F.size(code) + 1) % 2, lambda closed: of(code, closed)))


def cells(line: Column) -> Column:
    """The cells of a table's line, inline. A bar with a backslash before it is text."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|", ""), r"(?<!\\)\|$", "")
    return F.transform(F.split(bare, r"(?<!\\)\|", -1), lambda x: inline(F.replace(F.trim(x), F.lit("\\|"), F.lit("|"))))


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def table_html(lines: Column) -> Column:
    """A table's lines: the heads, a separator, the rows. A table of CARD_COLUMNS or more with a cell of over CARD_CHARS is to be shown as cards, so each cell keeps the name of its column."""
    def of(heads: Column) -> Column:
        def rows(body: Column, cards: Column) -> Column:
            td = lambda x, i: F.concat(F.lit("<td"), F.when(cards, F.concat(F.lit(' data-h="'), without_tags(F.coalesce(F.get(heads, i), F.lit(""))), F.lit('"'))).otherwise(""), F.lit(">"), x, F.lit("</td>"))
            tr = lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, td), ""), F.lit("</tr>"))
            th = F.array_join(F.transform(heads, lambda h: F.concat(F.lit("<th>"), h, F.lit("</th>"))), "")
            return F.concat(F.when(cards, '<table class="stack">').otherwise("<table>"), F.lit("<thead><tr>"), th, F.lit("</tr></thead><tbody>"), F.array_join(F.transform(body, tr), ""), F.lit("</tbody></table>"))

        longest = lambda body: F.array_max(F.transform(F.flatten(body), lambda x: F.length(without_tags(x))))
        shown = lambda body: let((F.size(heads) >= CARD_COLUMNS) & (F.coalesce(longest(body), F.lit(0)) > CARD_CHARS), lambda cards: rows(body, cards))
        return let(F.transform(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), cells), shown)

    return let(cells(F.get(lines, F.lit(0))), of)


def line_html(x: Column) -> Column:
    """A line outside tables: a heading (with an id from level two), a priority label, an exam tip, a list item or a paragraph; null for a blank one."""
    level = F.length(F.regexp_extract(x, "^(#{1,6}) ", 1))
    title = inline(F.regexp_replace(x, "^#{1,6} ", ""))
    ident = F.when(level == 2, F.concat(F.lit(' id="'), slug(without_tags(title)), F.lit('"'))).otherwise("")
    h = F.concat(F.lit("h"), level.cast("string"))
    prio = F.concat(F.lit('<p class="prio">Priority: <b>'), F.regexp_extract(x, PRIORITY, 1), F.lit("</b> · "), inline(F.regexp_extract(x, PRIORITY, 2)), F.lit("</p>"))
    tip = F.concat(F.lit('<div class="tip"><span class="lab">Exam tip:</span> '), inline(F.regexp_replace(x, TIP, "")), F.lit("</div>"))
    wrap = lambda tag, c: F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))
    html = F.when(level > 0, F.concat(F.lit("<"), h, ident, F.lit(">"), title, F.lit("</"), h, F.lit(">"))).when(x.rlike(PRIORITY), prio).when(x.rlike(TIP), tip)
    return html.when(F.startswith(x, F.lit("- ")), wrap("li", inline(F.substring(x, 3, 1 << 30)))).when(F.trim(x) != "", wrap("p", inline(x)))


def notes_html(text: Column) -> Column:
    """struct(body, toc) of a note. A table is two lines or more that begin with a bar, of which the second is its separator; items that follow each other are one list. toc: the headings of level two with their links, each with the tier of a
    priority label that comes right after it, blank lines aside; empty if there is none. A null text is empty."""
    def of(lines: Column) -> Column:
        bar = lambda i: F.coalesce(F.startswith(F.get(lines, i), F.lit("|")), F.lit(False))
        begins = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~(bar(i) & bar(i - 1)))
        # lines that begin with a bar and follow each other are one block, any other line is one of its own; so each line is gone through once
        blocks = let(begins, lambda b: F.transform(b, lambda a, k: F.slice(lines, a + 1, F.coalesce(F.get(b, k + 1), F.size(lines)) - a)))
        html = lambda g: F.when((F.size(g) > 1) & F.get(g, F.lit(1)).rlike(SEPARATOR), F.array(table_html(g))).otherwise(F.transform(g, line_html))
        parts = F.filter(F.flatten(F.transform(blocks, html)), lambda x: x.isNotNull())
        li = lambda x: F.startswith(x, F.lit("<li>"))
        lists = lambda p: F.transform(p, lambda x, i: F.concat(F.when(li(x) & ~F.coalesce(li(F.get(p, i - 1)), F.lit(False)), "<ul>").otherwise(""), x, F.when(li(x) & ~F.coalesce(li(F.get(p, i + 1)), F.lit(False)), "</ul>").otherwise("")))
        body = let(parts, lambda p: F.array_join(lists(p), "\n"))

        said = F.filter(lines, lambda x: F.trim(x) != "")
        head = lambda x: inline(F.regexp_replace(x, "^## ", ""))
        tier = lambda s, i: F.when(F.get(s, i + 1).rlike(PRIORITY), F.concat(F.lit(" <span class=t>"), F.regexp_extract(F.get(s, i + 1), PRIORITY, 1), F.lit("</span>"))).otherwise("")
        link = lambda t: F.concat(F.lit('<li><a href="#'), slug(t), F.lit('">'), t, F.lit("</a>"))
        item = lambda s: F.filter(F.transform(s, lambda x, i: F.when(F.startswith(x, F.lit("## ")), F.concat(let(without_tags(head(x)), link), F.coalesce(tier(s, i), F.lit("")), F.lit("</li>")))), lambda x: x.isNotNull())
        toc = let(let(said, item), lambda t: F.when(F.size(t) > 0, F.concat(F.lit('<nav class="toc"><div class="lab">In this chapter</div><ol>'), F.array_join(t, ""), F.lit("</ol></nav>"))).otherwise(""))
        return F.struct(body.alias("body"), toc.alias("toc"))

    return let(lines_of(F.coalesce(text, F.lit(""))), of)
