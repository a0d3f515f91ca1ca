"""Small frames with the odd cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, key int, kept boolean, __fp int"


def odd_documents(spark):
    long = " ".join(f"word{i} runs" for i in range(3000))
    texts = [(1, "one two three four\nfive six seven eight"), (2, "one two three four\nfive six seven eight"), (3, None), (4, ""), (5, " \t\n "), (6, "a"), (7, "a b"), (8, long), (9, long + " end"), (None, "null id text here"), (10, "é 日本 😀 \u0000 x y"), (1, "one two three four\nfive six seven eight"), (11, "THE Same Text"), (12, "the same text")]
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "s1", None if t is None else len(t), 0.5, "x", k, True, k) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)
