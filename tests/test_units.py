from __future__ import annotations

import pytest
from compare import same

from lectern import plans
from lectern.plans import base


@pytest.mark.parametrize("name", ["e04_paper_share", "e16_questions_per_paper", "e25_task_map", "e26_strongest_position", "e31_biggest_task", "e59_constraint_breaks"])
def test_units_of_many_tasks_have_the_same_results(spark, data, monkeypatch, name):
    monkeypatch.setattr(base, "TASK_ROWS", 500)
    same(plans.queries()[name](spark, data), plans.oracle_sql()[name], data)


def test_tasks_of_units_grow_with_the_rows(spark, data, monkeypatch):
    """Tasks hold TASK_ROWS rows or so, however many rows there are; what is grouped by paper isn't shuffled again."""
    monkeypatch.setattr(base, "TASK_ROWS", 500)
    u = base.units(spark, data)
    tasks = -(-u.count() // 500)
    assert tasks > 4 and u.rdd.getNumPartitions() == tasks and u.groupBy("paper", "q").count().rdd.getNumPartitions() == tasks


def test_rows_by_task_are_dealt_by_their_number(spark, data, monkeypatch):
    from lectern import plans

    few = sorted(map(tuple, plans.queries()["a19_rows_by_task"](spark, data).collect()), key=repr)
    monkeypatch.setattr(base, "TASK_ROWS", 500)
    many = plans.queries()["a19_rows_by_task"](spark, data)
    assert many.rdd.getNumPartitions() == 12  # 6,000 lines
    assert sorted(map(tuple, many.collect()), key=repr) == few
