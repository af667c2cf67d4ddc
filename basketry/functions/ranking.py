"""Rankings that stay distributed: over a whole table, and the latest rows of a key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.columns import hour_bucket

# A row by its value and its key.
Place = tuple[float | None, int]


# A selection is finished on so many rows at most, and its sketches err by one rank in so many.
FINISHED_ON = 4096
ACCURACY = 10_000
# Half the share of the ranks between the two values a sketch proposes; covers its error.
MARGIN = 2 / ACCURACY


@dataclass
class Cut:
    """Rows in the order of `value`, nulls last, and of the key: the first floor(n*percents[0]/100)
    get labels[0], those from there up to floor(n*percents[1]/100) labels[1], the rest labels[-1]."""

    value: str
    percents: list[int]
    labels: list[str]
    descending: bool = False

    def rising(self) -> Column:
        value = F.col(self.value).cast("double")
        return -value if self.descending else value

    def label(self, key: str, last_rows: list[Place | None]) -> Column:
        column = F.lit(self.labels[-1])
        for place, text in reversed(list(zip(last_rows, self.labels, strict=False))):
            if place is not None:
                column = F.when(self._up_to(key, place), F.lit(text)).otherwise(column)
        return column

    def _up_to(self, key: str, place: Place) -> Column:
        value, last = place
        limit = F.lit(value).cast("double")
        tied = self.rising().eqNullSafe(limit) & (F.col(key) <= F.lit(last))
        if value is None:
            return F.col(self.value).isNotNull() | tied
        return F.coalesce(self.rising() < limit, F.lit(False)) | tied


class _Search:
    """The row of one rank, looked for among fewer and fewer rows: by value, then by key among equal values.

    In question are the rows of `among` strictly between `low` and `high`, where these are known;
    `size` is how many they are, `rank` the wanted one of them.
    """

    def __init__(self, value: str, rank: int, present: int, total: int):
        self.value = F.col(value)
        self.found: Place | None = None
        if rank <= present:
            self.tied = self.low = self.high = None
            self.by, self.among = self.value, self.value.isNotNull()
            self.size, self.rank = present, rank
        else:
            self._among_equal(None, total - present, rank - present)

    def _among_equal(self, value: float | None, size: int, rank: int) -> None:
        self.by, self.tied, self.low, self.high = F.col("_key"), (value,), None, None
        self.among = self.value.isNull() if value is None else self.value == F.lit(value)
        self.size, self.rank = size, rank

    @property
    def inside(self) -> Column:
        inside = self.among
        if self.low is not None:
            inside = inside & (self.by > F.lit(self.low))
        if self.high is not None:
            inside = inside & (self.by < F.lit(self.high))
        return inside

    @property
    def short(self) -> bool:
        return self.size <= FINISHED_ON

    def proposal(self) -> Column:
        """The wanted row itself if few are left, else two values between which the rank should lie."""
        if self.short:
            rows = F.collect_list(F.when(self.inside, F.struct(self.value, F.col("_key"))))
            return F.sort_array(rows)[self.rank - 1]
        share = (self.rank - 0.5) / self.size
        around = [max(share - MARGIN, 0.0), min(share + MARGIN, 1.0)]
        return F.percentile_approx(F.when(self.inside, self.by), around, ACCURACY)

    def counts(self, bounds: list) -> Column:
        """Rows below, and up to, each of the two values."""
        return F.array(
            *(
                F.count(F.when(self.inside & beyond, 1))
                for bound in bounds
                for beyond in (self.by < F.lit(bound), self.by <= F.lit(bound))
            )
        )

    def narrow(self, bounds: list, counts: list[int]) -> None:
        """Keep the part that holds the rank: below, at, between or above the values.

        The counts are exact, so a sketch that errs costs a round and nothing else.
        """
        low, high = bounds
        under_low, to_low, under_high, to_high = counts
        for bound, under, to in ((low, under_low, to_low), (high, under_high, to_high)):
            if under < self.rank <= to:
                if self.tied is None:
                    self._among_equal(bound, to - under, self.rank - under)
                else:
                    self.found = (*self.tied, bound)
                return
        if self.rank <= under_low:
            self.high, self.size = low, under_low
        elif self.rank <= under_high:
            self.low, self.high, self.size = low, high, under_high - to_low
            self.rank -= to_low
        else:
            self.low, self.size = high, self.size - to_high
            self.rank -= to_high


def _settle(values: DataFrame, searches: list[_Search]) -> None:
    while pending := [search for search in searches if search.found is None]:
        proposed = values.agg(F.struct(*(search.proposal() for search in pending))).first()[0]
        wide = []
        for search, proposal in zip(pending, proposed, strict=True):
            if search.short:
                search.found = (proposal[0], proposal[1])
            else:
                wide.append((search, proposal))
        if wide:
            counted = values.agg(F.struct(*(search.counts(bounds) for search, bounds in wide))).first()[0]
            for (search, bounds), counts in zip(wide, counted, strict=True):
                search.narrow(bounds, counts)


def rank_cuts(df: DataFrame, key: str, cuts: list[Cut]) -> tuple[list[Column], int]:
    """The label of each cut, as a column of its value and the unique numeric `key`, and the number of rows.

    Only the rows at the cuts are looked for, and nothing is sorted, moved or written: a mergeable
    sketch of the quantiles proposes two values around each rank, an exact count tells on which
    side of them the rank lies, and so on inside that part, for all cuts at once. A round leaves
    well below a thousandth of the values, so a billion rows take three; among equal values the keys
    are searched alike. The last few thousand rows of a search are sorted in one aggregate.
    Every round reads `df` twice: hand in a table that is stored, or cheap to form.
    """
    values = df.select(
        F.col(key).alias("_key"), *(cut.rising().alias(f"_{i}") for i, cut in enumerate(cuts))
    )
    total, *present = values.agg(
        F.count(F.lit(1)), *(F.count(f"_{i}") for i in range(len(cuts)))
    ).first()
    searches = {
        (i, percent): _Search(f"_{i}", total * percent // 100, present[i], total)
        for i, cut in enumerate(cuts)
        for percent in cut.percents
        if total * percent // 100
    }
    _settle(values, list(searches.values()))
    labels = [
        cut.label(key, [searches[i, p].found if (i, p) in searches else None for p in cut.percents])
        for i, cut in enumerate(cuts)
    ]
    return labels, total


def latest_per_key(
    df: DataFrame, keys: list[str], moment: str, tie_break: str, count: int
) -> DataFrame:
    """The `count` most recent rows of every key (all rows of a key that has fewer).

    Rows without a key belong to nobody and drop out; rows without a moment are
    the least recent ones. Rows are ranked inside (key, clock hour), where the first `count` are
    left before anything is moved, and shifted by the number of later rows of the key, for every
    count alike: no task sees more of a hot key than one hour of rows, or one count per hour.
    """
    newest = [F.col(moment).desc_nulls_last(), F.col(tie_break).desc_nulls_last()]
    hourly = [*keys, "_hour"]
    rows = df.dropna(subset=keys).withColumn("_hour", hour_bucket(moment))
    later = F.sum("_rows").over(
        W.partitionBy(*keys)
        .orderBy(F.desc_nulls_last("_hour"))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*hourly)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *(F.col(key).alias(f"_{key}") for key in keys),
            F.col("_hour").alias("_of_hour"),
            F.coalesce(later, F.lit(0)).alias("_later"),
        )
        .filter(F.col("_later") < count)
    )
    same = F.col("_hour").eqNullSafe(F.col("_of_hour"))
    for key in keys:
        same = same & (F.col(key) == F.col(f"_{key}"))
    rank = F.row_number().over(W.partitionBy(*hourly).orderBy(*newest))
    return (
        rows.withColumn("_rank", rank)
        .filter(F.col("_rank") <= count)
        .join(offsets, same)
        .filter(F.col("_rank") + F.col("_later") <= count)
        .select(*df.columns)
    )
