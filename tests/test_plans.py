"""Plan shape guards for the main operators."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from scan_plans import plan_counts  # noqa: E402


from mercato.registry import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_cartesian_or_python(spark, name):
    c = plan_counts(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert c["nested_loop"] == 0 and c["cartesian"] == 0 and c["python"] == 0


def test_scan_prunes_columns(sf001):
    from mercato.operators import orders as O

    plan = O.order_wait_time(sf001)._jdf.queryExecution().executedPlan().toString()
    schemas = plan.split("ReadSchema: ")[1:]
    assert schemas and all("o_totalprice" not in s and "o_orderpriority" not in s for s in schemas)


def test_a_stored_status_is_filtered_in_the_scan(spark, tmp_path):
    from helpers import make_tables, order

    from mercato.operators import orders as O

    tables = make_tables(spark, orders=[order("o1"), order("o2", status="shipped")])
    tables["orders"].write.parquet(str(tmp_path / "orders"))
    stored = tables | {"orders": spark.read.parquet(str(tmp_path / "orders"))}
    plan = O.order_wait_time(stored)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(order_status,delivered)" in pushed


def test_items_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """A task's share of the items stays the same however many there are; the rows are those of the undivided table."""
    from mercato.plans import spread
    from mercato.sources import fixture

    whole = fixture._build(spark, "/root/testdata/sf0.001")["order_items"]
    monkeypatch.setattr(spread, "ROWS_PER_TASK", 100)
    dealt = fixture._build(spark, "/root/testdata/sf0.001")["order_items"]
    sizes = [n for n in dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert sum(sizes) == whole.count() and max(sizes) < 3 * spread.ROWS_PER_TASK
    assert dealt.exceptAll(whole).count() == 0 and whole.exceptAll(dealt).count() == 0


def test_review_scores_over_dealt_items(spark, monkeypatch):
    from mercato.operators.products import product_review_score
    from mercato.plans import spread
    from mercato.sources import fixture

    def rows():
        return sorted(tuple(round(x, 9) for x in r) for r in product_review_score(fixture._build(spark, "/root/testdata/sf0.001")).collect())

    whole = rows()
    monkeypatch.setattr(spread, "ROWS_PER_TASK", 100)
    assert rows() == whole
