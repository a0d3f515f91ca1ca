"""SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from lectern.llm.quality_rules import COMMON_WORDS, MAX_CLASS_DISTANCE, MIN_CHARS, MIN_WORDS, SCALE_STEPS, WORD_MOST, WORD_SLACK, WORD_SPREAD

EMBEDDINGS = r"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""

REPEATS = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM w WHERE len(w) >= 50),
g AS (SELECT doc_id, i - 1 AS s, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM p),
c AS (SELECT g, count(*) AS copies, min(doc_id) AS first_id FROM g GROUP BY g HAVING count(*) > 1),
h AS (SELECT doc_id, s, copies, first_id, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 50 THEN 0 ELSE 1 END AS fresh FROM g JOIN c USING (g)),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM h)
SELECT doc_id, CAST(min(s) AS INTEGER) AS first_word, CAST(max(s) + 50 - min(s) AS INTEGER) AS n_words, min(first_id) AS first_doc_id, max(copies) AS copies FROM k GROUP BY doc_id, run
"""

CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', ''),
x AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS said,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(13 + length(replace(replace(replace(replace(role, '\', '\\'), '### ', '\h'), '</turn>', '\t'), chr(10), '\n')) + length(replace(replace(replace(text, '\', '\\'), '### ', '\h'), '</turn>', '\t'))) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM x
"""

MIX = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('s' || source, 'n') AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
z AS (SELECT src, CAST(floor(sqrt(count(*))) AS BIGINT) AS share FROM d GROUP BY src),
s AS (SELECT src, share, CAST(sum(share) OVER () AS BIGINT) AS slots, row_number() OVER (ORDER BY share DESC, src) AS i FROM z),
q AS (SELECT list(share ORDER BY i) AS q, any_value(slots) AS slots FROM s),
edf AS (SELECT CAST(-1 AS BIGINT) AS t, CAST(0 AS BIGINT) AS pick, list_transform(q, lambda x: CAST(0 AS BIGINT)) AS done, q, slots FROM q WHERE slots IS NOT NULL
  UNION ALL
  SELECT t + 1, p, list_transform(done, lambda d, i: d + CASE WHEN i = p THEN 1 ELSE 0 END), q, slots FROM (
    SELECT *, CAST(list_min(list_filter(list_transform(done, lambda d, i: CASE WHEN (d * slots) // q[i] <= t + 1 THEN (((d + 1) * slots + q[i] - 1) // q[i]) * 100000 + i END), lambda b: b IS NOT NULL)) % 100000 AS BIGINT) AS p
    FROM edf WHERE t + 1 < slots)),
y AS (SELECT s.src, t AS stand, row_number() OVER (PARTITION BY s.src ORDER BY t) - 1 AS nth FROM edf JOIN s ON s.i = edf.pick WHERE t >= 0),
r AS (SELECT doc_id, source, src, row_number() OVER (PARTITION BY src ORDER BY h, doc_id) - 1 AS seat FROM (SELECT d.*, documents.source FROM d JOIN documents USING (doc_id))),
b AS (SELECT r.*, seat // 16 AS block FROM r)
SELECT doc_id, source, share, slots, block, (block * slots) // share AS release, ((block + 1) * slots + share - 1) // share AS deadline, (block // share) * slots + stand AS slot, ((block // share) * slots + stand) * 16 + seat % 16 AS place
FROM b JOIN s USING (src) JOIN y ON y.src = b.src AND y.nth = b.block % s.share
"""


def quality_rules_sql() -> str:
    """Each document's counts by unnesting its windows and lines, its histograms class by class, and the same references and guards."""
    classes = ["[a-zß-öø-ÿ]", "[A-ZÀ-ÖØ-Þ]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?''\"()\-]", r"[#*$%&|<>]"]
    left = ["t"]
    for c in classes:
        left.append(f"regexp_replace({left[-1]}, '{c}+', '', 'g')")
    hist = ", ".join([f"length({a}) - length({b})" for a, b in zip(left, left[1:])] + [f"length({left[-1]})"])
    cases = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in COMMON_WORDS.items())
    share = "list_transform({0}, lambda x: x / list_sum({0}))"
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
    term = f"({part.format('z[1]', 'z[2]')} + {part.format('z[2]', 'z[1]')}) / 2"
    distance = lambda a, b: f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest(0, least(1, list_sum(list_transform(list_zip({share.format(a)}, {share.format(b)}), lambda z: {term}))))) END"
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)),
m AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM m, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id),
b AS (SELECT d.doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, length(t) AS n_chars, [{hist}] AS classes,
    ' ' || regexp_replace(lower(t), '[\x20\x09-\x0D.,;:!?''\"()]+', '  ', 'g') || ' ' AS padded, coalesce(CASE lang {cases} END, []) AS listed FROM d LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, list_transform(listed, lambda x: CAST((strlen(padded) - strlen(replace(padded, ' ' || x || ' ', ''))) / strlen(' ' || x || ' ') AS BIGINT)) AS common,
    len(list_filter(string_split_regex(padded, ' +'), lambda x: x <> '')) AS all_words FROM b),
h AS (SELECT *, list_append(common, greatest(0, all_words - coalesce(list_sum(common), 0))) AS words FROM f),
rc AS (SELECT lang, list(v ORDER BY k) AS ref_classes FROM (SELECT lang, k, sum(classes[k]) AS v FROM h, generate_series(1, {len(classes) + 1}) s(k) WHERE NOT base_failed GROUP BY lang, k) GROUP BY lang),
rw AS (SELECT lang, list(v ORDER BY k) AS ref_words FROM (SELECT lang, k, sum(words[k]) AS v FROM h, generate_series(1, 21) s(k) WHERE NOT base_failed AND words[k] IS NOT NULL GROUP BY lang, k) GROUP BY lang),
j AS (SELECT h.*, CASE WHEN n_chars >= {MIN_CHARS} THEN {distance('classes', 'ref_classes')} END AS dc, CASE WHEN n_words >= {MIN_WORDS} AND len(words) > 1 THEN {distance('words', 'ref_words')} END AS dw, {distance("list_transform(ref_words, lambda x, i: CASE WHEN i = len(ref_words) THEN 1 ELSE 0 END)", 'ref_words')} AS d0
    FROM h LEFT JOIN rc ON h.lang IS NOT DISTINCT FROM rc.lang LEFT JOIN rw ON h.lang IS NOT DISTINCT FROM rw.lang),
w AS (SELECT lang, quantile_disc(CAST(floor(dw * sqrt(n_words) * {SCALE_STEPS}) AS BIGINT), 0.5) AS middle FROM j WHERE NOT base_failed AND dw IS NOT NULL GROUP BY lang)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(dc, 0) <= {MAX_CLASS_DISTANCE} AND coalesce(dw <= least({WORD_MOST} * d0, {WORD_SLACK} + {WORD_SPREAD} * (middle + 1) / {SCALE_STEPS} / sqrt(n_words)), TRUE) AS kept
FROM j LEFT JOIN w ON j.lang IS NOT DISTINCT FROM w.lang
"""


TIES = r"""
WITH RECURSIVE bits AS (SELECT i AS n, i AS c, 0 AS k FROM generate_series(0, 255) t(i) UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
ids AS (SELECT sale_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(sale_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 5 = 0 AS one FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL), crc),
l AS (SELECT CASE WHEN one THEN -1 ELSE vendor_id END AS vendor_id, CASE WHEN one THEN -1 ELSE coalesce(item_id % 5, -1) END AS part,
    CASE WHEN one THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS month,
    CAST(floor(quantity / 10) AS BIGINT) AS tens, CAST(floor(100 * discount + 0.5) AS BIGINT) AS percent, sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity,
    CAST(floor(100 * amount + 0.5) AS BIGINT) AS amount_cents FROM sale_lines LEFT JOIN ids USING (sale_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
    count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied FROM l)
SELECT vendor_id, part, month, pos, pos AS place, sale_id, line_no, quantity, percent, amount_cents, tied FROM r WHERE pos <= 2
"""

#: Units are listed as they match, the hash draws are read as hexadecimal numbers, and each output is put together from lists of units; what is restored must be the text.
MIDDLES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
n AS (SELECT *, len(u) AS n, list_transform([0, 1, 2, 3], lambda k: CAST('0x' || substr(h, CAST(8 * k + 1 AS BIGINT), 8) AS BIGINT)) AS x FROM d),
c AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR x[3] % 100 >= 90 THEN 'plain' WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""

ORACLES = {
    "op2_embedding_near_dedup": EMBEDDINGS,
    "op5_suffix_array_dedup": REPEATS,
    "op6_chat_formatting": CHAT,
    "op9_source_mix": MIX,
    "op10_quality_rules": quality_rules_sql(),
    "op11_grouped_ranking_ties": TIES,
    "op12_fill_in_middle": MIDDLES,
}
