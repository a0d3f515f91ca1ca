from __future__ import annotations

import pytest
from compare import same

from lectern import plans


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_agrees_with_sql(spark, data, name):
    same(plans.queries()[name](spark, data), plans.oracle_sql()[name], data)


def test_entry_module_has_every_query(spark, data):
    import __spark_entry__ as entry

    assert set(plans.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_shares_sum_to_all_and_do_not_depend_on_order(spark, data):
    from lectern.operators import stats
    from lectern.plans.base import units

    u = units(spark, data)
    rows = sorted(map(tuple, stats.fractional_shares(u).collect()))
    assert abs(sum(r[2] for r in rows) - 100) < 1e-9
    assert rows == sorted(map(tuple, stats.fractional_shares(u.orderBy("marks", "q")).collect()))


def test_near_duplicates_agree_with_the_plain_loop(spark, data):
    import re
    from difflib import SequenceMatcher

    from lectern.plans.base import table

    docs = [(r.doc_id, r.source, re.sub(r"[\x20\x09-\x0D]+", " ", r.text).strip(" ")) for r in table(spark, data, "documents").collect()]
    rows = plans.queries()["d09_near_duplicates"](spark, data).collect()
    key = lambda t: re.findall("[a-z]+", t.lower())[:3]
    first, owners = {}, {}
    for i, p, t in sorted(docs):
        if len(t) > 30:
            first.setdefault(t, i)
            owners.setdefault(t, set()).add(p)
    texts = {i: t for t, i in first.items()}
    want = {(a, b) for a in texts for b in texts if a < b and key(texts[a]) == key(texts[b]) and len(owners[texts[a]] | owners[texts[b]]) > 1 and SequenceMatcher(None, texts[a], texts[b]).ratio() > 0.55}
    assert {(r.a, r.b) for r in rows if r.kind == "pair"} == want
    assert {(r.a, r.b) for r in rows if r.kind == "copy"} == {(first[t], i) for i, _, t in docs if t in first and first[t] != i}
