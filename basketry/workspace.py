"""All derived tables and offers over one set of inputs, each built once."""

from __future__ import annotations

from contextlib import AbstractContextManager
from functools import cached_property

from pyspark.sql import Column, DataFrame

from basketry.functions.columns import check_mode
from basketry.operators import cross_sell as cross_sell_ops
from basketry.operators import customers as customer_ops
from basketry.operators import groups as group_ops
from basketry.operators import history as history_ops
from basketry.operators import offers as offer_ops
from basketry.operators import periods as period_ops
from basketry.operators import quality
from basketry.operators.history import analysis_moment
from basketry.schema import Tables
from basketry.session import delete, new_path, part_of, passes, within, written_in_passes


class Workspace:
    """Derived tables are lazy and shared between the offers.

    The customer table writes its sums and looks for its rank cuts when it is first asked for. The history is
    written to the shared folder where one result reads it twice; call store_history() to do
    it before forming several offers. close(), or leaving a with block, deletes what was
    written; results read from it are of no use afterwards.

    min_purchases: how often a pair must have been bought to be in the group table; 1 keeps all.
    """

    def __init__(self, tables: Tables, mode: str = "spec", min_purchases: int = 2):
        self.tables = tables
        self.mode = check_mode(mode)
        self.min_purchases = min_purchases
        self._history: DataFrame | None = None
        self._folder: str | None = None

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        """Delete what was written: history, pairs and sums per customer and store, if any."""
        if self._folder is not None:
            delete(self.tables.checks.sparkSession, [self._folder])
        self._folder, self._history = None, None
        self.__dict__.pop("customers", None)

    def _kept(self) -> AbstractContextManager[None]:
        """What is written inside lies in this workspace's own folder."""
        if self._folder is None:
            self._folder = new_path(self.tables.checks.sparkSession, "workspace")
        return within(self._folder)

    @property
    def history(self) -> DataFrame:
        """Purchase history with discount measures, the base of all group measures."""
        if self._history is None:
            return history_ops.discounted_history(self.tables, self.mode)
        return self._history

    def store_history(self) -> Workspace:
        """Write the history down, long ones part by part; everything built from now on reads the copy."""
        if self._history is None:
            with self._kept():
                self._history = written_in_passes(
                    history_ops.discounted_history(part, self.mode)
                    for part in history_ops.receipt_parts(self.tables)
                )
        return self

    @property
    def analysis(self) -> Column:
        return analysis_moment(self.tables)

    @property
    def purchase_history(self) -> DataFrame:
        if self._history is None:
            return history_ops.purchase_history(self.tables)
        return history_ops.plain_history(self._history)

    @property
    def periods(self) -> DataFrame:
        return period_ops.periods(self.history)

    @cached_property
    def customers(self) -> DataFrame:
        with self._kept():
            return customer_ops.customers(self.tables, self.mode)

    @property
    def group_details(self) -> DataFrame:
        return group_ops.group_details(
            self.history, self.analysis, mode=self.mode, min_purchases=self.min_purchases
        )

    @property
    def groups(self) -> DataFrame:
        return self.group_details.select(*group_ops.GROUP_COLUMNS)

    def stored_details(self, method: int = 0, number: int = 1) -> DataFrame:
        """group_details by a margin method, written down customers by customers.

        A short history is not worth it: there the table stays one lazy plan.
        """
        if method == 2:
            self.store_history()
        parts = passes(self.tables.checks if self._history is None else self._history)
        if parts > 1:
            self.store_history()
        mode, least, history = self.mode, self.min_purchases, self.history
        if parts == 1:
            return group_ops.group_details(history, self.analysis, method, number, mode, least)
        with self._kept():
            return written_in_passes(
                group_ops.group_details(
                    part_of(history, "customer_id", part, parts),
                    self.analysis, method, number, mode, least, history,
                )
                for part in range(parts)
            )

    def stored_groups(self, method: int = 0, number: int = 1) -> DataFrame:
        """groups_by_margin, for tables whose shuffles would not fit the disk all at once."""
        return self.stored_details(method, number).select(*group_ops.GROUP_COLUMNS)

    @property
    def offer_candidates(self) -> DataFrame:
        """The pairs with what offers ask of them, but for affinity and stability."""
        return group_ops.pair_candidates(self.history, self.analysis, self.min_purchases)

    def with_affinity(self, pairs: DataFrame) -> DataFrame:
        """Pairs with their affinity; they are written down first, as they are read twice."""
        with self._kept():
            pairs = written_in_passes([pairs])
        return group_ops.with_affinity(pairs, self.history, self.mode)

    def reward_group(self, max_churn, max_discount_share, margin_share, **choices) -> DataFrame:
        """The group each customer is rewarded in; pairs that do not qualify never reach a time line."""
        self.store_history()
        return offer_ops.reward_group(
            self.offer_candidates,
            max_churn,
            max_discount_share,
            margin_share,
            price_margin=self.price_margin,
            affinity=self.with_affinity,
            **choices,
        )

    def groups_by_margin(self, method: int = 0, number: int = 1) -> DataFrame:
        """The group table with the margin of a period of days (1) or of the last purchases (2)."""
        if method == 2:
            self.store_history()
        return group_ops.groups(
            self.history, self.analysis, method, number, self.mode, self.min_purchases
        )

    @property
    def price_margin(self) -> DataFrame:
        return offer_ops.group_price_margin(self.tables)

    def offers_average_check(self, method: int, **parameters) -> DataFrame:
        self.store_history()
        return offer_ops.offers_average_check(
            self.tables,
            self.offer_candidates,
            method,
            price_margin=self.price_margin,
            affinity=self.with_affinity,
            mode=self.mode,
            **parameters,
        )

    def offers_visit_frequency(self, start, end, added: int, **parameters) -> DataFrame:
        self.store_history()
        return offer_ops.offers_visit_frequency(
            self.tables,
            self.offer_candidates,
            customer_ops.customer_frequency(self.tables),
            start,
            end,
            added,
            affinity=self.with_affinity,
            mode=self.mode,
            **parameters,
        )

    def cross_sell_selected(self, count: int, max_churn: float, max_stability: float) -> DataFrame:
        """The pairs cross-selling chooses, written down, as offers read them more than once."""
        self.store_history()
        details = self.stored_details()
        with self._kept():
            return written_in_passes(
                [
                    cross_sell_ops.cross_sell_groups(
                        details, count, max_churn, max_stability, self.mode
                    )
                ]
            )

    def offers_cross_sell_counted(
        self, count: int, max_churn, max_stability, max_sku_share, margin_share
    ) -> DataFrame:
        """Mode "as_written": the different offers, and in `repeats` how often the SQL gives each."""
        if self.mode != "as_written":
            raise ValueError("offers are repeated in mode 'as_written' only")
        return cross_sell_ops.offers_cross_sell_counted(
            self.tables,
            self.history,
            self.cross_sell_selected(count, max_churn, max_stability),
            customer_ops.primary_store(self.tables, self.mode),
            max_sku_share,
            margin_share,
        )

    def offers_cross_sell(self, count: int, **parameters) -> DataFrame:
        if self.mode == "as_written":
            return cross_sell_ops.spread(self.offers_cross_sell_counted(count, **parameters))
        self.store_history()
        return cross_sell_ops.offers_cross_sell(
            self.tables,
            self.history,
            self.stored_details(),
            customer_ops.primary_store(self.tables, self.mode),
            count,
            **parameters,
        )

    def validate(self) -> DataFrame:
        return quality.validate(self.tables, self.mode)

    def register_views(self, prefix: str = "") -> None:
        """Temporary views of inputs and derived tables for use from SQL."""
        views = dict(self.tables.items()) | {
            "purchase_history": self.purchase_history,
            "periods": self.periods,
            "customers": self.customers,
            "groups_": self.groups,
        }
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
