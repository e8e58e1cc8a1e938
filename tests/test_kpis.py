"""KPIs of several slices come from one pass over their result."""

import re

from helpers import day, frame
from shoploom.plans.metrics import kpis
from test_operators import physical

LINES = "sku string, line_item_type string, order_date date, email string, line_total decimal(18,2), quantity bigint, is_converted_purchase int"


def sold(sku, email, **more):
    return dict(sku=sku, email=email, line_item_type="Product", order_date=day("2024-01-03"), line_total=10, quantity=2, is_converted_purchase=0) | more


def test_line_kpis_read_the_lines_once(spark):
    """Before, the line fact was made and read once per slice."""
    rows = [
        sold("FL-1", "x"), sold("FL-1", "x", is_converted_purchase=1), sold("FL-1", "y", line_item_type="Sample", quantity=None),
        sold("FL-1", None, order_date=day("2024-01-10")), sold("FL-2", "x", line_total=None), sold(None, "z", line_item_type=None),
    ]
    df = kpis(frame(spark, LINES, rows), "fct_order_lines")
    assert len(re.findall(r"Scan ExistingRDD|LocalTableScan", physical(df))) == 1
    got = {(r.kpi, r.slice): r.value for r in df.collect()}
    assert len(got) == df.count()
    assert {k[1]: v for k, v in got.items() if k[0] == "SKU Revenue"} == {"FL-1": 40.0, "FL-2": None, "": 10.0}
    assert {k[1]: v for k, v in got.items() if k[0] == "SKU Units Sold"} == {"FL-1": 6.0, "FL-2": 2.0, "": 2.0}
    assert {k[1]: v for k, v in got.items() if k[0] == "Sample vs Product Distribution"} == {"Product": 4.0, "Sample": 1.0, "": 1.0}
    assert {k[1]: v for k, v in got.items() if k[0] == "Converted Purchases"} == {"all": 1.0}
    assert {k[1]: v for k, v in got.items() if k[0] == "Weekly SKU Customer Count"} == {
        "2023-12-31|FL-1": 2.0, "2024-01-07|FL-1": 0.0, "2023-12-31|FL-2": 1.0, "2023-12-31": 1.0,
    }


def test_shares_and_an_empty_result(spark):
    stages = "is_converted_session int, funnel_stage_depth int, deepest_funnel_stage string, transaction_value decimal(18,2)"
    rows = [dict(deepest_funnel_stage=s, is_converted_session=0, funnel_stage_depth=1) for s in ("a", "a", "a", "b")]
    got = {(r.kpi, r.slice): r.value for r in kpis(frame(spark, stages, rows), "sessions").collect()}
    assert got["Funnel Dropoff Analysis", "a"] == 75.0 and got["Session Conversion Rate", "all"] == 0.0
    assert kpis(frame(spark, LINES, []), "fct_order_lines").count() == 0
