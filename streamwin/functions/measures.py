"""The aggregate bundles a window reports, in direct and in two-step form.

Every measure decomposes, so a bundle can be computed straight from the rows
(``direct``) or from narrow time panes: ``partial`` over the rows of a pane,
``merged`` over the panes of a window. Averages merge as sum over non-null
count, because ``count(*)`` also counts rows without a price.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measures:
    """A choice of measures, reported in the order of ``names``.

    ``price_scale`` is the number of decimals prices have. Given, they are
    summed as whole multiples of the last decimal: the average then no longer
    depends on the order in which partitions are added up, and repeated runs
    give the same bits. Left at ``None``, prices are averaged as doubles.
    """

    names: tuple[str, ...]
    price: str = "price"
    volume: str = "volume"
    price_scale: int | None = None

    def exact(self, scale: int = 2) -> Measures:
        return replace(self, price_scale=scale)

    def direct(self) -> list[Column]:
        forms = {
            "event_count": lambda: F.count("*"),
            "total_volume": lambda: F.sum(self.volume),
            "avg_price": lambda: (
                F.avg(self.price)
                if self.price_scale is None
                else self._average(F.sum(self._addend()), F.count(self.price))
            ),
            "max_price": lambda: F.max(self.price),
            "min_price": lambda: F.min(self.price),
        }
        return [forms[name]().alias(name) for name in self.names]

    def partial(self) -> list[Column]:
        forms = {
            "event_count": lambda: [F.count("*").alias("_rows")],
            "total_volume": lambda: [F.sum(self.volume).alias("_volume")],
            "avg_price": lambda: [
                F.sum(self._addend()).alias("_price_sum"),
                F.count(self.price).alias("_priced"),
            ],
            "max_price": lambda: [F.max(self.price).alias("_price_max")],
            "min_price": lambda: [F.min(self.price).alias("_price_min")],
        }
        return [part for name in self.names for part in forms[name]()]

    def combined(self) -> list[Column]:
        """Panes put together into a wider pane."""
        forms = {"_price_max": F.max, "_price_min": F.min}
        names = {
            "event_count": ["_rows"],
            "total_volume": ["_volume"],
            "avg_price": ["_price_sum", "_priced"],
            "max_price": ["_price_max"],
            "min_price": ["_price_min"],
        }
        return [forms.get(part, F.sum)(part).alias(part) for name in self.names for part in names[name]]

    def merged(self) -> list[Column]:
        forms = {
            "event_count": lambda: F.sum("_rows"),
            "total_volume": lambda: F.sum("_volume"),
            "avg_price": lambda: self._average(F.sum("_price_sum"), F.sum("_priced")),
            "max_price": lambda: F.max("_price_max"),
            "min_price": lambda: F.min("_price_min"),
        }
        return [forms[name]().alias(name) for name in self.names]

    def _addend(self) -> Column:
        price = F.col(self.price)
        return price if self.price_scale is None else F.rint(price * 10**self.price_scale).cast("bigint")

    def _average(self, total: Column, count: Column) -> Column:
        sum_of_prices = total if self.price_scale is None else total.cast("double") / float(10**self.price_scale)
        return sum_of_prices / F.nullif(count, F.lit(0))


# The bundles and the order of their columns.
FULL = Measures(("event_count", "total_volume", "avg_price", "max_price", "min_price"))
BASELINE = Measures(("event_count", "total_volume", "avg_price"))
COUNT_AND_AVERAGE = Measures(("event_count", "avg_price"))
COUNT_ONLY = Measures(("event_count",))
