"""Queries of the text, segmentation and duplicate operators over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import dedup, quality, segments
from lectern.operators.graphs import cut
from lectern.operators.joins import contained
from lectern.plans.base import query, table

WS = r"[\x20\x09-\x0D]+"
SQUEEZE = rf"trim(regexp_replace({{0}}, '{WS}', ' ', 'g'))"
SIGNS = "'‘’“”–—−•', '''''""---*'"
DUPLICATE = (
    r"regexp_replace(translate(regexp_replace(regexp_replace(regexp_replace(text, '!\[[^\]]*\]\([^)]*\)', 'IMG', 'g'), '[0-9]{4}/[0-9]{2}[A-Za-z/0-9]*', ' ', 'g'), '\*\*\[[0-9]+\]\*\*|\[[0-9]+\]', ' ', 'g'), "
    + SIGNS
    + r"), '\.{2,}', ' ', 'g')"
)
QUOTE = f"replace(replace(replace(translate(text, {SIGNS}), 'ﬁ', 'fi'), 'ﬂ', 'fl'), '…', '...')"
#: Words apart by two spaces, so that a match of a spaced word leaves the next one's space.
SPACED = r"'  ' || regexp_replace(text, '[^\p{L}\p{N}\p{M}_]+', '  ', 'g') || '  '"
#: Words that stand for command words in invented prose.
COMMANDS = ("The", "And", "Of", "In", "That", "It", "Der", "Die", "La", "Le", "Que")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


@query(r"WITH a AS (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\x20\x09]+$', '')), lambda x: NOT regexp_matches(x, '^.{0,3}$|!!|[#$%&]{3}')), chr(10)) AS t FROM documents) SELECT doc_id, md5(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g')) AS cleaned_md5, length(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g')) AS n FROM a")
def c06_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junk lines are very short ones, shouting and runs of symbols."""
    c = fn.kept_lines(F.col("text"), r"^.{0,3}$|!!|[#$%&]{3}")
    return docs(spark, sf_dir).select("doc_id", c.alias("c")).select("doc_id", F.md5(F.col("c").cast("binary")).alias("cleaned_md5"), F.char_length("c").cast("long").alias("n"))


@query(f"SELECT doc_id, md5(lower({SQUEEZE.format(DUPLICATE)})) AS norm_md5 FROM documents")
def h01_duplicate_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.md5(fn.duplicate_norm(F.col("text")).cast("binary")).alias("norm_md5"))


@query("SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS norm_md5 FROM documents")
def h02_alnum_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.md5(fn.alnum_norm(F.col("text")).cast("binary")).alias("norm_md5"))


@query(f"SELECT doc_id, md5(lower({SQUEEZE.format(QUOTE)})) AS norm_md5 FROM documents")
def h03_quote_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.md5(fn.quote_norm(F.col("text")).cast("binary")).alias("norm_md5"))


@query(rf"WITH e AS (SELECT doc_id, unnest(regexp_extract_all({SPACED}, ' ({'|'.join(COMMANDS)}) ', 1)) AS command FROM documents) SELECT command, count(*) AS n, count(DISTINCT doc_id) AS docs FROM e GROUP BY command")
def e05_command_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E05."""
    e = docs(spark, sf_dir).select("doc_id", F.explode(fn.all_of(F.col("text"), COMMANDS)).alias("command"))
    return e.groupBy("command").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(rf"SELECT lang, count(*) FILTER (WHERE len(regexp_extract_all({SPACED}, ' ({'|'.join(COMMANDS)}) ', 1)) = 0) AS without, count(*) AS n FROM documents GROUP BY lang")
def e06_without_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir)
    return d.groupBy("lang").agg(F.count_if(F.size(fn.all_of(F.col("text"), COMMANDS)) == 0).alias("without"), F.count(F.lit(1)).alias("n"))


@query(rf"WITH s AS (SELECT doc_id, text, regexp_extract({SPACED}, ' ({'|'.join(COMMANDS)}) ', 1) AS a, regexp_extract(lower({SPACED}), ' ({'|'.join(c.lower() for c in COMMANDS)}) ', 1) AS b FROM documents) SELECT doc_id, CASE WHEN length(text) > 0 THEN coalesce(nullif(a, ''), CASE WHEN b <> '' THEN upper(b[1]) || b[2:] END, 'Other') END AS command FROM s")
def h04_first_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", fn.first_of(F.col("text"), COMMANDS).alias("command"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+')[1:3], ' ') AS bucket FROM documents")
def h06_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", fn.bucket_key(F.col("text")).alias("bucket"))


@query(rf"SELECT doc_id, regexp_extract({SQUEEZE.format('''split_part(text, '**[', 1)''')}, '^([^.?]*[.?]?)', 1) AS stem FROM documents")
def h08_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", fn.stem(F.col("text")).alias("stem"))


@query(r"SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE regexp_replace(substr(text, 1, 300), '\n[^\n]*$', '') || chr(10) || '...' END AS cut, CASE WHEN length(text) <= 60 THEN text ELSE regexp_replace(substr(text, 1, 60), ' [^ ]*$', '') || '…' END AS clip FROM documents")
def h16_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H16, H17."""
    return docs(spark, sf_dir).select("doc_id", fn.truncated(F.col("text"), 300).alias("cut"), fn.clipped(F.col("text"), 60).alias("clip"))


@query("WITH p(name, p) AS (VALUES ('symbols', '[#$%&]{3}'), ('shout', '!!'), ('mail', '[a-z]+@[a-z]+'), ('licence', '(?i)licen[cs]e'), ('number', '[0-9]{6,}')) SELECT name, CAST(sum(len(regexp_extract_all(text, p))) AS BIGINT) AS n, count(*) FILTER (WHERE regexp_matches(text, p)) AS docs FROM documents, p GROUP BY name")
def e51_junk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pattern_counts(docs(spark, sf_dir), "text", {"symbols": "[#$%&]{3}", "shout": "!!", "mail": "[a-z]+@[a-z]+", "licence": "(?i)licen[cs]e", "number": "[0-9]{6,}"})


@query("WITH f AS (SELECT source, max(CAST(regexp_matches(text, 'ing\\b') AS INT)) AS a, max(CAST(regexp_matches(text, 'tion\\b') AS INT)) AS b, max(CAST(regexp_matches(text, 'zheit\\b') AS INT)) AS c FROM documents GROUP BY source) SELECT CAST(sum(a) AS BIGINT) AS ing, CAST(sum(b) AS BIGINT) AS tion, CAST(sum(c) AS BIGINT) AS zheit, CAST(sum(greatest(a, b, c)) AS BIGINT) AS family FROM f".replace("\\\\", "\\"))
def e37_skill_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with a text that has a word ending; the family counts a source once."""
    has = lambda p: F.max(F.col("text").rlike(p).cast("int"))
    f = docs(spark, sf_dir).groupBy("source").agg(has(r"ing\b").alias("a"), has(r"tion\b").alias("b"), has(r"zheit\b").alias("c"))
    return f.agg(F.sum("a").alias("ing"), F.sum("b").alias("tion"), F.sum("c").alias("zheit"), F.sum(F.greatest("a", "b", "c")).alias("family"))


@query(r"SELECT doc_id, CASE WHEN len(m) > 0 THEN CAST(list_sum(m) AS BIGINT) END AS marks FROM (SELECT doc_id, list_transform(regexp_extract_all('[' || length(text) || '] ' || text || ' [2]', '\[([0-9]+)\]', 1), lambda x: CAST(x AS BIGINT)) AS m FROM documents)")
def c17_marks_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(F.lit("["), F.char_length("text"), F.lit("] "), F.col("text"), F.lit(" [2]"))
    return docs(spark, sf_dir).select("doc_id", fn.marks_in(marked).alias("marks"))


@query("SELECT doc_id, session, CAST(year AS INTEGER) AS year, variant, CASE WHEN variant[1] = '0' THEN variant[2] ELSE variant END[1] AS paper_no FROM (SELECT doc_id, ['m', 's', 'w'][doc_id % 3 + 1] AS session, 2000 + 17 + doc_id % 10 AS year, lpad(CAST(doc_id % 44 AS VARCHAR), 2, '0') AS variant FROM documents) WHERE variant IS NOT NULL")
def c01_code_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C01-C04, on codes made from the ids."""
    d = docs(spark, sf_dir)
    code = F.concat(F.lit("9626_"), F.element_at(F.array(*map(F.lit, "msw")), (F.col("doc_id") % 3 + 1).cast("int")), (F.col("doc_id") % 10 + 17).cast("string"), F.lit("_qp_"), F.lpad((F.col("doc_id") % 44).cast("string"), 2, "0"))
    return d.select("doc_id", fn.code_parts(code).alias("c")).select("doc_id", "c.*")


@query(r"""SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '(?i)<p>')) AS paragraphs, len(regexp_extract_all(html, '(?i)<h[1-6]')) AS headings, len(regexp_extract_all(html, '(?i)<a ')) AS links, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host FROM pages""")
def a15_page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a page by patterns."""
    p = table(spark, sf_dir, "pages")
    n = lambda x: F.regexp_count("html", F.lit(x)).cast("long")
    return p.select("page_id", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"), n("(?i)<p>").alias("paragraphs"), n("(?i)<h[1-6]").alias("headings"), n("(?i)<a ").alias("links"), F.regexp_extract("url", "^[a-z]+://([^/]*)", 1).alias("host"))


@query(r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g') AS t FROM pages), b AS (SELECT page_id, regexp_replace(regexp_replace(t, '(?i)</(p|div|li|h[1-6]|tr)>|<br>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS t FROM a), c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS t FROM b), d AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '[\x20\x09]+', ' ', 'g'), ' ?\n[\x20\n]*', chr(10), 'g')) AS t FROM c) SELECT page_id, md5(t) AS text_md5, length(t) AS n_chars FROM d""")
def h25_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of pages."""
    p = table(spark, sf_dir, "pages").select("page_id", fn.html_text(F.col("html")).alias("t"))
    return p.select("page_id", F.md5(F.col("t").cast("binary")).alias("text_md5"), F.char_length("t").cast("long").alias("n_chars"))


LINES = "l AS (SELECT doc_id, unnest(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10)))))) AS z FROM documents), k AS (SELECT doc_id, z[2] AS pos, z[1] AS line FROM l)"


@query(f"WITH {LINES}, b AS (SELECT *, coalesce(sum(CASE WHEN regexp_matches(line, 'th\\.$') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block FROM k) SELECT doc_id, CAST(block AS BIGINT) AS block, CAST(min(pos) AS INTEGER) AS first, count(*) AS n, md5(string_agg(line, chr(10) ORDER BY pos)) AS body_md5 FROM b GROUP BY doc_id, block")
def f03_marked_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block ends at each line that ends in `th.`."""
    lines = segments.line_table(docs(spark, sf_dir), "doc_id", "text")
    b = segments.marked_blocks(lines, "doc_id", F.col("line").rlike(r"th\.$"))
    return b.select("doc_id", "block", "first", "n", F.md5(F.col("body").cast("binary")).alias("body_md5"))


@query(f"WITH {LINES}, s AS (SELECT *, sum(CASE WHEN length(line) BETWEEN 1 AND 12 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM k) SELECT doc_id, CAST(section AS BIGINT) AS section, arg_min(line, pos) AS title, count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars FROM s WHERE section > 0 GROUP BY doc_id, section")
def a04_heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines stand for headings."""
    lines = segments.line_table(docs(spark, sf_dir), "doc_id", "text")
    return segments.heading_sections(lines, "doc_id", F.length("line").between(1, 12))


@query("WITH s AS (SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 80 AS batch FROM documents) SELECT source, batch, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM s GROUP BY source, batch")
def b03_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = segments.batches(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], ["doc_id"], "doc_id")
    return b.select("source", "batch", F.size("ids").cast("long").alias("n"), F.array_min("ids").alias("first"), F.array_max("ids").alias("last"))


@query("WITH RECURSIVE v AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: CASE WHEN length(x) % 4 < 3 THEN length(x) % 4 + 1 END) AS v FROM documents), r AS (SELECT doc_id, v, 1 AS i, 0 AS accepted, CAST(NULL AS BIGINT) AS last_place, 0 AS last FROM v UNION ALL SELECT doc_id, v, i + 1, accepted + CAST(ok AS INT), CASE WHEN ok THEN i - 1 ELSE last_place END, CASE WHEN ok THEN v[i] ELSE last END FROM (SELECT *, coalesce(v[i] = last + 1, false) AS ok FROM r WHERE i <= len(v))) SELECT doc_id, accepted, last_place FROM r WHERE i = len(v) + 1")
def f01_question_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F01, on the lengths of lines modulo 4 as numbers: how many are accepted and where the last is."""
    n = F.transform(F.split("text", "\n", -1), lambda x: F.when(F.length(x) % 4 < 3, (F.length(x) % 4 + 1).cast("int")))
    return docs(spark, sf_dir).select("doc_id", segments.accepted_starts(n).alias("p")).select("doc_id", F.size("p").alias("accepted"), F.array_max("p").alias("last_place"))


@query("SELECT doc_id, CASE WHEN text <> '' AND doc_id <> first THEN first END AS dupe_of, CASE WHEN text <> '' AND doc_id = first AND n > 1 THEN n - 1 END AS also_in FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first, count(*) OVER (PARTITION BY text) AS n FROM documents)")
def e54_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies fold into the first."""
    f = dedup.folded(docs(spark, sf_dir), [F.sha2(F.col("text").cast("binary"), 256), F.nullif("text", F.lit(""))], F.col("doc_id"), "doc_id")
    return f.select("doc_id", "dupe_of", "also_in")


@query(rf"WITH f AS (SELECT lang, doc_id AS paper, list_sort(list_transform(string_split(text, chr(10)), lambda x: substr({SQUEEZE.format('x')}, 1, 200))) AS p FROM documents), g AS (SELECT *, min(paper) OVER (PARTITION BY lang, p) AS first FROM f) SELECT paper, first FROM g WHERE paper <> first")
def d19_duplicate_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = docs(spark, sf_dir).select("lang", F.col("doc_id").alias("paper"), F.explode(F.split("text", "\n", -1)).alias("text"))
    return dedup.duplicate_papers(b, ["lang"])


@query(f"WITH {LINES}, n AS (SELECT trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) AS key, CAST(substr(source, 4) AS INTEGER) AS s FROM k JOIN documents USING (doc_id)) SELECT key, count(DISTINCT s) AS n, max(s) AS latest FROM n WHERE key <> '' GROUP BY key HAVING count(DISTINCT s) >= 2")
def e22_exact_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wordings of lines that two sources or more have."""
    lines = segments.line_table(docs(spark, sf_dir).withColumn("key", F.struct("doc_id", "source")), "key", "text").withColumn("s", F.substring("key.source", 4, 10).cast("int"))
    r = dedup.repeats(lines, fn.alnum_norm(F.col("line")), ["s"])
    return r.select("key", "n", F.col("latest.s").alias("latest"))


@query(None)
def d09_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of whole texts of different sources, and the copies of each."""
    d = docs(spark, sf_dir).select("doc_id", "source", fn.squeeze(F.col("text")).alias("stem"))
    return dedup.near_duplicates(d, "doc_id", "source", "stem")


@query("SELECT * FROM (SELECT source, sha256(string_agg(p, '' ORDER BY p)) AS print FROM (SELECT source, d[1:3] || sha256(string_agg(d, '' ORDER BY d)) AS p FROM (SELECT source, sha256(CAST(doc_id AS VARCHAR) || chr(1) || text || chr(1)) AS d FROM documents) GROUP BY source, d[1:3]) GROUP BY source)")
def h21_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fingerprints(docs(spark, sf_dir), ["source"], "doc_id", "text")


@query(rf"WITH w AS (SELECT source, lang, unnest(string_split({SQUEEZE.format('text')}, ' ')) AS w FROM documents), c AS (SELECT w, count(*) FILTER (WHERE source < 'src2') AS a, count(*) FILTER (WHERE source >= 'src2') AS b FROM w WHERE w <> '' GROUP BY w) SELECT w AS word, a - b AS missing FROM c WHERE a > b")
def e60_multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that some sources have more often than the others."""
    d = docs(spark, sf_dir)
    return quality.multiset_missing(d.where("source < 'src2'"), d.where("source >= 'src2'"), "text")


@query("SELECT doc_id, coalesce(CAST(quality AS VARCHAR), '?') AS confidence FROM documents LEFT JOIN labels USING (doc_id)")
def d05_label_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("?")).alias("confidence"))


@query("SELECT coalesce(CAST(quality AS VARCHAR), '?') AS confidence, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def e50_confidence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d05_label_or_default(spark, sf_dir).groupBy("confidence").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def d03_untagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("WITH v AS (SELECT 'unlabelled' AS rule, CAST(doc_id AS VARCHAR) AS id FROM documents ANTI JOIN labels USING (doc_id) UNION ALL SELECT 'bad quality', CAST(doc_id AS VARCHAR) FROM labels WHERE quality NOT IN (0, 1) OR quality IS NULL UNION ALL SELECT 'wrong length', CAST(doc_id AS VARCHAR) FROM documents WHERE n_chars <> length(text)) SELECT rule, count(*) AS n, min(id) AS example FROM v GROUP BY rule")
def q_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and what breaks them."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.violations({
        "unlabelled": d.select("doc_id").join(lab.select("doc_id"), "doc_id", "left_anti").select(F.col("doc_id").alias("id")),
        "bad quality": lab.where("quality is null or quality not in (0, 1)").select(F.col("doc_id").alias("id")),
        "wrong length": d.where(F.col("n_chars") != F.char_length("text")).select(F.col("doc_id").alias("id")),
    })


@query("WITH m AS (SELECT doc_id, quality = 1 AS a, toxic = 0 AS b FROM labels), g AS (SELECT doc_id, CASE WHEN (doc_id % 2 = 0 AND CAST(a AS INT) + CAST(b AS INT) >= 1) OR CAST(a AS INT) + CAST(b AS INT) >= 2 THEN 'A' WHEN doc_id % 2 = 0 OR CAST(a AS INT) + CAST(b AS INT) = 1 THEN 'B' ELSE 'C' END AS grade FROM m) SELECT grade, count(*) AS n FROM g GROUP BY grade")
def e53_provenance_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    g = quality.provenance_grade(F.array(F.col("quality") == 1, F.col("toxic") == 0), F.col("doc_id") % 2 == 0)
    return lab.select(g.alias("grade")).groupBy("grade").agg(F.count(F.lit(1)).alias("n"))


@query(rf"SELECT item_id, doc_id FROM benchmark b, documents d WHERE contains({SQUEEZE.format('d.text')}, {SQUEEZE.format('b.text')})")
def d10_quotes_in_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts that a document holds word for word."""
    needles = table(spark, sf_dir, "benchmark").select("item_id", fn.squeeze(F.col("text")).alias("needle"))
    texts = table(spark, sf_dir, "documents").select("doc_id", fn.squeeze(F.col("text")).alias("text"))
    return contained(needles, texts, "doc_id").select("item_id", "doc_id")


#: Each order is a folder, its lines the tasks; covers, pages, files and notes have a fault where the key says.
LEAVES = """pl AS (SELECT o_orderkey AS leaf, '7 ' || o_orderpriority || ' of ' || o_orderstatus || o_orderstatus || ' and more' AS chapter, year(o_orderdate) AS year, list_sort(list_distinct(list(CAST(l_linenumber AS BIGINT)))) AS tasks FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
cv AS (SELECT leaf, kind, chapter, year, tasks, CASE WHEN leaf % 11 = 1 AND kind = 'QP' THEN '' ELSE chapter END || ' ' || CASE WHEN leaf % 13 = 2 THEN '' ELSE CAST(year AS VARCHAR) END || CASE WHEN leaf % 17 = 3 THEN ' PAPER' WHEN kind = 'QP' THEN ' QUESTIONS' ELSE ' MARK SCHEME' END AS text,
    CASE WHEN leaf % 7 = 4 AND kind = 'MS' THEN tasks || [9] WHEN leaf % 19 = 5 THEN [8] || tasks ELSE tasks END AS shown FROM pl, (VALUES ('QP'), ('MS')) AS t(kind) WHERE NOT (leaf % 23 = 6 AND kind = 'MS') AND leaf % 29 <> 7)"""


@query(f"""WITH {LEAVES},
ok AS (SELECT * FROM pl WHERE leaf % 23 <> 6 AND leaf % 29 <> 7), oc AS (SELECT * FROM cv WHERE leaf IN (SELECT leaf FROM ok)), fs AS (SELECT leaf, unnest(tasks) AS t FROM ok)
SELECT leaf, 'document missing' AS problem, CASE WHEN leaf % 29 = 7 THEN 'QP' ELSE 'MS' END AS detail FROM pl WHERE leaf % 23 = 6 OR leaf % 29 = 7
UNION ALL SELECT leaf, 'cover without', kind || ' ' || substr(chapter, 3, 18) FROM oc WHERE NOT contains(text, substr(chapter, 3, 18)) UNION ALL SELECT leaf, 'cover without', kind || ' ' || year FROM oc WHERE NOT contains(text, CAST(year AS VARCHAR))
UNION ALL SELECT leaf, 'cover not labelled', kind FROM oc WHERE leaf % 17 = 3
UNION ALL SELECT leaf, 'covers disagree', NULL FROM ok WHERE leaf % 7 = 4
UNION ALL SELECT leaf, 'tasks not planned', array_to_string(shown, ',') FROM oc WHERE kind = 'QP' AND leaf % 19 = 5
UNION ALL SELECT leaf, 'page without banner', kind || ' ' || CASE WHEN leaf % 5 > 1 THEN leaf % 5 ELSE 2 END FROM oc WHERE leaf % 3 = 0 AND (leaf % 5 > 1 OR leaf % 2 = 0)
UNION ALL SELECT leaf, 'file missing or not planned', 'f' || t || '.zip' FROM fs WHERE (leaf + t) % 31 = 8 UNION ALL SELECT leaf, 'file missing or not planned', 'extra.zip' FROM ok WHERE leaf % 37 = 9
UNION ALL SELECT leaf, 'file not in notes', 'f' || t || '.zip' FROM fs WHERE (leaf + t) % 41 = 10 OR leaf % 43 = 11""")
def k14_leaf_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders held against their plan: documents, covers, banners, files and notes."""
    leaf, o = F.col("leaf"), table(spark, sf_dir, "orders")
    tasks = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("leaf")).agg(F.array_sort(F.collect_set(F.col("l_linenumber").cast("long"))).alias("tasks"))
    chapter = F.concat(F.lit("7 "), "o_orderpriority", F.lit(" of "), "o_orderstatus", "o_orderstatus", F.lit(" and more"))
    pl = cut(o.select(F.col("o_orderkey").alias("leaf"), chapter.alias("chapter"), F.year("o_orderdate").alias("year")).join(tasks, "leaf"))  # read by each table below
    file = lambda t: F.concat(F.lit("f"), t.cast("string"), F.lit(".zip"))
    kinds = pl.withColumn("kind", F.explode(F.array(F.lit("QP"), F.lit("MS"))))
    qp = F.col("kind") == "QP"
    kept = kinds.where(~((leaf % 23 == 6) & ~qp) & (leaf % 29 != 7))
    label = F.when(leaf % 17 == 3, " PAPER").when(qp, " QUESTIONS").otherwise(" MARK SCHEME")
    text = F.concat(F.when((leaf % 11 == 1) & qp, "").otherwise(F.col("chapter")), F.lit(" "), F.when(leaf % 13 == 2, "").otherwise(F.col("year").cast("string")), label)
    one = lambda n: F.array(F.lit(n).cast("long"))
    shown = F.when((leaf % 7 == 4) & ~qp, F.concat("tasks", one(9))).when(leaf % 19 == 5, F.concat(one(8), "tasks")).otherwise(F.col("tasks"))
    covers = kept.select("leaf", "kind", text.alias("text"), shown.alias("tasks"))
    page = kept.select("leaf", "kind", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("page"))
    banner = (leaf % 3 != 0) | ((F.col("page") != leaf % 5) & ~((F.col("page") == 2) & (leaf % 5 <= 1) & (leaf % 2 == 0)))
    each = pl.select("leaf", F.explode("tasks").alias("t"))
    held = each.where((leaf + F.col("t")) % 31 != 8).select("leaf", file(F.col("t")).alias("file")).unionByName(pl.where(leaf % 37 == 9).select("leaf", F.lit("extra.zip").alias("file")))
    notes = pl.select("leaf", F.when(leaf % 43 != 11, F.array_join(F.transform(F.filter("tasks", lambda t: (leaf + t) % 41 != 10), file), ", ")).alias("text"))
    plan = pl.withColumn("files", F.transform("tasks", file))
    return quality.leaf_problems(plan, covers, page.withColumn("banner", banner), held, notes)
