"""A registered query: its key, the Spark plan and the independent SQL."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin_session
from .inexact import INEXACT
from .views import with_views

Plan = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame, inexact: Collection[str] = ()) -> DataFrame:
    """Result in the form both engines can agree on bit by bit.

    Minus zero becomes zero; dates become text and booleans 0/1.  Doubles stay as they are, but for those whose last
    digits hang on the order of additions, which are cut to single precision.
    """
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            shown = c.cast("float").cast("double") if field.name in inexact else c
            # adding zero leaves every number but minus zero; a comparison per column makes the code of a wide row too long to be compiled
            c = shown + F.lit(0.0)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(field.name))
    return df.select(*out)


def comparable_sql(sql: str, doubles: str, dates: str, flags: str, inexact: Collection[str] = ()) -> str:
    changes = []
    for c in doubles.split():
        shown = f"cast(cast({c} as float) as double)" if c in inexact else f"cast({c} as double)"
        changes.append(f"case when {shown} = 0 then cast(0 as double) else {shown} end as {c}")
    changes += [f"strftime({c}, '%Y-%m-%d') as {c}" for c in dates.split()]
    changes += [f"cast({c} as integer) as {c}" for c in flags.split()]
    if not changes:
        return sql
    return "select * replace (\n  " + ",\n  ".join(changes) + "\n) from (\n" + sql + "\n) as expected"


@dataclass(frozen=True)
class Check:
    key: str
    plan: Plan
    sql: str | None = None
    doubles: str = ""
    dates: str = ""
    flags: str = ""

    @property
    def inexact(self) -> list[str]:
        return INEXACT.get(self.key, "").split()

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(self.plan(pin_session(spark), sf_dir), self.inexact)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return with_views(comparable_sql(self.sql.strip(), self.doubles, self.dates, self.flags, self.inexact))
