"""The pipeline from the three raw inputs to the modelling table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from promolens.operators import eventlog, features, opportunities, timeline
from promolens.operators.layout import TASK_ROWS, Limits, dimension
from promolens.sources import Clustering, read_table, testdata, write_tables

#: What `Campaign.store` writes.
TABLES = [
    "offers_processed",
    "transactions_processed",
    "profile_processed",
    "events_by_customer",
    "events_apart",
    "event_log",
    "opportunities",
]


class Campaign:
    """Lazy tables of one campaign, planned so that wide attributes are joined late.

    `at_most` is an upper bound on the event count, if known; it spares counting. `counted` are
    tables with as many rows as `offers` and `profile`, where those are cheaper to count.
    """

    def __init__(
        self,
        offers: DataFrame,
        profile: DataFrame,
        transactions: DataFrame,
        at_most: int | None = None,
        counted: tuple[DataFrame, DataFrame] | None = None,
    ):
        self.offers = offers
        self.profile_raw = profile
        self.transactions = transactions
        self.limits = Limits(at_most=at_most)
        self._counted = counted or (offers, profile)

    @staticmethod
    def of_testdata(spark: SparkSession, sf_dir: str) -> Campaign:
        # Answered from file footers, without reading the rows.
        at_most = testdata.table(spark, sf_dir, "events").count()
        return Campaign(
            testdata.offers(spark, sf_dir),
            testdata.profile(spark, sf_dir),
            testdata.transactions(spark, sf_dir),
            at_most,
            (testdata.table(spark, sf_dir, "part"), testdata.table(spark, sf_dir, "customer")),
        )

    @cached_property
    def events(self) -> DataFrame:
        return eventlog.flatten_events(self.transactions)

    @cached_property
    def profile(self) -> DataFrame:
        return eventlog.clean_profile(self.profile_raw)

    @cached_property
    def joined_offers(self) -> DataFrame:
        """The offers as joins take them."""
        return dimension(self.offers, self._counted[0])

    @cached_property
    def joined_profile(self) -> DataFrame:
        """The cleaned profiles as joins take them."""
        return dimension(self.profile, self._counted[1])

    @cached_property
    def log(self) -> DataFrame:
        return eventlog.event_log(self.events, self.joined_profile, self.joined_offers)

    @cached_property
    def clustered(self) -> timeline.Clustered:
        """The narrow events by customer: dealt once, or read from a clustered table."""
        return timeline.clustered(self.events, self.limits)

    @cached_property
    def receipts(self) -> DataFrame:
        return timeline.receipts(self.clustered, limits=self.limits)

    @cached_property
    def opportunities(self) -> DataFrame:
        return opportunities.opportunities_of_receipts(
            self.receipts, self.joined_offers, self.joined_profile
        )

    def opportunities_with_band(self, rel_error: float = 0.01) -> DataFrame:
        return opportunities.with_limit_band(self.opportunities, rel_error, self.limits)

    @cached_property
    def registrations(self) -> DataFrame:
        return features.active_registrations(self.joined_profile, self.events)

    @cached_property
    def opportunities_with_history(self) -> DataFrame:
        """Opportunities with the running history of their customer; only what is used of it is
        computed."""
        return opportunities.opportunities_of_receipts(
            self.receipts, self.joined_offers, self.joined_profile, timeline.history_names()
        )

    @cached_property
    def abt(self) -> DataFrame:
        return features.abt_of_opportunities(
            self.opportunities_with_history,
            self.joined_offers,
            self.joined_profile,
            self.registrations,
            timeline.history_names(),
        )

    def store(
        self, path: str | None = None, suffix: str = "", buckets: int | None = None
    ) -> Campaign:
        """Write the tables the analysis hands on to the catalog; returns the campaign that reads
        them.

        The inputs are parsed and cleaned once: the log and the opportunities are computed from
        the stored tables, not from the raw files again. The narrow events are stored by customer,
        so that responses and history need no shuffle of events any more; those of customers too
        busy for one task lie in a table of their own. A bucket is read by one task: by default
        there are as many as the number of events asks for, eight at least.
        """
        spark = self.offers.sparkSession
        name = {t: f"{t}{suffix}" for t in TABLES}
        write_tables(
            {
                name["offers_processed"]: self.offers,
                name["transactions_processed"]: self.events,
                name["profile_processed"]: self.profile,
            },
            path,
        )
        offers, events, profile = (read_table(spark, name[t]) for t in TABLES[:3])
        stored = Campaign(offers, profile, events, self.limits.at_most)
        stored.limits = self.limits
        parts = timeline.split_busy(events, self.limits)
        # Answered from file footers, without reading the rows.
        buckets = buckets or max(8, -(-events.count() // TASK_ROWS))
        by_customer = Clustering((timeline.USER,), ("t_us",), buckets)
        write_tables(
            {name["events_by_customer"]: parts.together}, path, {name["events_by_customer"]: by_customer}
        )
        if parts.apart is not None:
            write_tables({name["events_apart"]: parts.apart}, path)
        stored.clustered = timeline.Clustered(
            read_table(spark, name["events_by_customer"]),
            None if parts.apart is None else read_table(spark, name["events_apart"]),
        )
        write_tables({name["event_log"]: stored.log}, path)
        write_tables({name["opportunities"]: stored.opportunities_with_band()}, path)
        stored.log = read_table(spark, name["event_log"])
        stored.opportunities = read_table(spark, name["opportunities"])
        return stored
