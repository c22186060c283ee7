"""What the physical plans must and must not hold; whole pipelines with hot keys forced."""

import re

import compare
import pytest

import __spark_entry__ as contract
from promolens.operators import evaluation, layout, segments
from promolens.operators.layout import Limits
from promolens.plans import queries
from promolens.plans.campaign import Campaign
from promolens.sources import testdata

FORCED = Limits(chunks=64, min_rows=3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["abt", "opportunities", "funnel_by_offer_type", "limit_band",
                                  "recency_conversion", "decile_table", "eval_summary",
                                  "distinct_counts", "registration_quartile"])
def test_no_cross_join(name, spark, sf_dir):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_what_it_needs(spark, sf_dir):
    df = Campaign.of_testdata(spark, sf_dir).events.select("account_id", "event")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)
    assert schema == "user_id:bigint,event_type:string"


def test_shuffles_of_the_modelling_table(spark, sf_dir):
    """Events move once, by customer; from the clustered table they do not move at all."""
    text = plan(Campaign.of_testdata(spark, sf_dir).abt)
    by_customer = r"Exchange hashpartitioning\(user_id"
    assert len(re.findall(by_customer, text)) == 1
    # The rest is of customers: dates of profiles, their first orders, the customers with an event.
    of_customers = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert set(of_customers) == {"user_id", "id", "o_custkey"}
    assert "SortAggregate" not in text
    with queries._stored(spark, sf_dir) as stored:
        text = plan(stored.abt)
    assert not re.findall(by_customer, text)
    assert "events_by_customer" in text
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", text)) == {"id"}


def test_every_campaign_table_but_one_comes_without_the_history(spark, sf_dir):
    """Opportunities share the receipts, whose unused windows are pruned."""
    text = plan(Campaign.of_testdata(spark, sf_dir).opportunities)
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", text)) == 1
    assert len(re.findall(r"- Window ", text)) == 1


def test_layout_names_no_broadcast_of_a_dimension(spark, sf_dir):
    c = Campaign.of_testdata(spark, sf_dir)
    logical = c.log._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical


@pytest.mark.parametrize("table", ["opportunities", "abt"])
def test_forced_cells_change_nothing(table, spark, sf_dir):
    plain = Campaign.of_testdata(spark, sf_dir)
    cut = Campaign.of_testdata(spark, sf_dir)
    cut.limits = FORCED
    assert compare.spark_result(getattr(plain, table)) == compare.spark_result(getattr(cut, table))


def test_forced_cells_change_no_report(spark, sf_dir):
    c = Campaign.of_testdata(spark, sf_dir)
    scored = testdata.scored(spark, sf_dir)
    for report in (
        lambda n: evaluation.decile_table(scored, "key", n),
        lambda n: evaluation.ks(scored, n),
        lambda n: segments.recency_conversion(c.events, c.opportunities, n),
        lambda n: segments.tx_value_box(c.events, n),
    ):
        assert compare.spark_result(report(None)) == compare.spark_result(report(FORCED))


def test_large_dimensions_are_not_sent_to_every_task(spark, sf_dir, monkeypatch):
    """Their rows count, not their stored bytes; the tables stay the same."""
    small = Campaign.of_testdata(spark, sf_dir)
    found = {t: sorted(map(str, getattr(small, t).collect())) for t in ("log", "abt")}
    monkeypatch.setattr(layout, "SENT_ROWS", 20)
    large = Campaign.of_testdata(spark, sf_dir)
    for name, rows in found.items():
        df = getattr(large, name)
        assert sorted(map(str, df.collect())) == rows
        # The adapter of the test tables joins customers with their orders by itself.
        assert set(re.findall(r"BroadcastHashJoin \[(\w+)", plan(df))) <= {"c_custkey"}


def test_events_without_an_offer_are_dealt_to_many_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(layout, "SENT_ROWS", 20)
    c = Campaign.of_testdata(spark, sf_dir)
    dealt = re.findall(r"Exchange hashpartitioning\((coalesce\(offer_id[^,]*, concat\(~)", plan(c.log))
    assert len(dealt) == 1
    assert c.log.where("offer_id is null and offer_type is not null").isEmpty()
