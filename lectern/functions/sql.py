"""Functions of the library for SQL text. Their bodies are SQL themselves, so Catalyst puts them into the plan and no Python runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name and signature, and the body.
FUNCTIONS = {
    "squeezed(s STRING) RETURNS STRING": r"RETURN trim(regexp_replace(s, r'[\x20\x09-\x0D]+', ' '))",
    "stated_marks(s STRING) RETURNS BIGINT": r"RETURN aggregate(nullif(regexp_extract_all(s, r'\[([0-9]+)\]', 1), array()), 0L, (t, x) -> t + CAST(x AS BIGINT))",
    "percent_of(part DOUBLE, whole DOUBLE) RETURNS DOUBLE": "RETURN coalesce(100 * part / nullif(whole, 0), 0)",
    "text_lines(s STRING) RETURNS TABLE(nth INT, line STRING)": r"RETURN SELECT pos, col FROM (SELECT posexplode(split(s, r'\n')))",
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to this session, in place of earlier ones of these names; their names. text_lines is a table function: FROM t, LATERAL text_lines(t.text). Null texts give null, and no lines; a text without a stated mark null."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} {body}")
    return [head.split("(")[0] for head in FUNCTIONS]
