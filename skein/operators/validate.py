"""Row validation (P20): a rule list becomes one error-array column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL_RX = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


@dataclass
class Rule:
    column: str
    kind: str          # required | nonempty | min | max | date | email | pattern
    arg: object = None

    def failed(self) -> Column:
        c = F.col(self.column)
        if self.kind == "required":
            return c.isNull()
        if self.kind == "nonempty":
            return c.isNull() | (F.trim(c.cast("string")) == "")
        if self.kind == "min":
            v = c.cast("string").try_cast("double")
            return v.isNull() | (v < self.arg)
        if self.kind == "max":
            v = c.cast("string").try_cast("double")
            return v.isNull() | (v > self.arg)
        if self.kind == "date":
            return c.isNull() | F.try_to_date(c.cast("string"), self.arg or "yyyy-MM-dd").isNull()
        if self.kind == "email":
            return c.isNull() | ~c.rlike(EMAIL_RX)
        if self.kind == "pattern":
            return c.isNull() | ~c.rlike(self.arg)
        raise ValueError(self.kind)

    @property
    def key(self) -> str:
        return f"{self.column}:error.{self.kind}"


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``errors`` (array of ``column:error.kind``) and ``valid``."""
    errs = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.key)) for r in rules]))
    return df.withColumn("errors", errs).withColumn("valid", F.size("errors") == 0)


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    v = validate(df, rules)
    return v.filter("valid").drop("errors", "valid"), v.filter(~F.col("valid"))
