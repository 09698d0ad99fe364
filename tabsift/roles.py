"""Column roles and time windows passed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Roles:
    """Which columns are ids, target and date; all other columns are features."""

    ids: tuple[str, ...]
    target: str
    date: str
    ignored: tuple[str, ...] = field(default=())

    def __post_init__(self):
        ids = (self.ids,) if isinstance(self.ids, str) else tuple(self.ids)
        object.__setattr__(self, "ids", ids)
        object.__setattr__(self, "ignored", tuple(self.ignored))

    @property
    def fixed(self) -> list[str]:
        return [*self.ids, self.target, self.date]

    def features(self, df: DataFrame) -> list[str]:
        """Feature columns in table order. ``split`` is the tag of split_by_date."""
        taken = {*self.fixed, *self.ignored, "split"}
        return [c for c in df.columns if c not in taken]

    def numeric(self, df: DataFrame) -> list[str]:
        return [c for c in self.features(df) if isinstance(df.schema[c].dataType, T.NumericType)]

    def categorical(self, df: DataFrame) -> list[str]:
        return [c for c in self.features(df) if isinstance(df.schema[c].dataType, T.StringType)]

    def other(self, df: DataFrame) -> list[str]:
        known = {*self.numeric(df), *self.categorical(df)}
        return [c for c in self.features(df) if c not in known]


@dataclass(frozen=True)
class Windows:
    """Closed train and out-of-time windows as ISO dates, checked on creation."""

    train_start: str
    train_end: str
    oot_start: str
    oot_end: str

    def __post_init__(self):
        for start, end in ((self.train_start, self.train_end), (self.oot_start, self.oot_end)):
            if datetime.fromisoformat(start) > datetime.fromisoformat(end):
                raise ValueError(f"window starts after its end: {start} > {end}")

    @property
    def overlap(self) -> bool:
        a, b, c, d = (
            datetime.fromisoformat(x)
            for x in (self.train_start, self.train_end, self.oot_start, self.oot_end)
        )
        return a <= d and c <= b


def date_bound(df: DataFrame, date: str, value: str) -> Column:
    """Literal of the column's own type, so that the comparison is pushed to the scan."""
    kind = df.schema[date].dataType
    return F.lit(value) if isinstance(kind, T.StringType) else F.lit(value).cast(kind)


def within(df: DataFrame, date: str, start: str, end: str) -> Column:
    """Closed date range; a text date column is parsed first."""
    if isinstance(df.schema[date].dataType, T.StringType):
        return F.to_timestamp(date).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return F.col(date).between(date_bound(df, date, start), date_bound(df, date, end))


def month_of(date: str) -> Column:
    return F.date_format(date, "yyyy-MM")
