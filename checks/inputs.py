"""The given tables in the role of the credit inputs."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import vocab
from creditloom.plans import gold, insights, silver
from creditloom.sources import adapter, rules, storage
from creditloom.tuning import tune


class Inputs:
    """The credit inputs as adapter views over one data directory, and the layers above them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = storage.read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = adapter.spark_view(name, self.table)
        return self._views[name]

    @cached_property
    def train(self) -> DataFrame:
        return self.view("applications").where(~F.col("flag_test")).drop("flag_test")

    @cached_property
    def test(self) -> DataFrame:
        return self.view("applications").where(F.col("flag_test")).drop("flag_test", "target")

    @cached_property
    def applications(self) -> DataFrame:
        return silver.applications(self.train, self.test)

    @cached_property
    def bureau(self) -> DataFrame:
        return silver.bureau(self.view("bureau"))

    @cached_property
    def bureau_balance(self) -> DataFrame:
        return silver.bureau_balance(self.view("bureau_balance"))

    @cached_property
    def previous(self) -> DataFrame:
        return silver.previous_application(self.view("previous_application"))

    @cached_property
    def payments(self) -> DataFrame:
        return silver.installments_payments(self.view("installments_payments"))

    @cached_property
    def card(self) -> DataFrame:
        return silver.credit_card_balance(self.view("credit_card_balance"))

    @cached_property
    def pos(self) -> DataFrame:
        return silver.pos_cash_balance(self.view("pos_cash_balance"))

    @cached_property
    def external_behavior(self) -> DataFrame:
        return silver.external_behavior(self.bureau, self.bureau_balance)

    @cached_property
    def internal_behavior(self) -> DataFrame:
        return silver.internal_behavior(self.previous, self.payments, self.card, self.pos)

    @cached_property
    def external(self) -> DataFrame:
        return gold.client_external(self.external_behavior)

    @cached_property
    def internal(self) -> DataFrame:
        return gold.client_internal(self.internal_behavior)

    @cached_property
    def rule_rows(self):
        return rules.default_band_rows()

    @cached_property
    def band_rules(self) -> DataFrame:
        return rules.default_band_rules(self.spark)

    @cached_property
    def spine(self) -> DataFrame:
        return gold.application_spine(self.applications)

    @cached_property
    def portfolio(self) -> DataFrame:
        return insights.portfolio(self.applications, self.internal, self.external, self.rule_rows)

    @cached_property
    def event_log(self) -> DataFrame:
        return self.view("event_log")


RAW_NAMES = {(file, bronze_name): raw for file, raw, _, bronze_name in vocab.RENAMES}


def raw_text(df: DataFrame, file: str = "") -> DataFrame:
    """A bronze-typed table as the raw files hold it: upper-case names, everything text."""

    def as_text(f: T.StructField):
        column = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            yes, no = ("Y", "N") if f.name.startswith("flag_own") else ("1", "0")
            column = F.when(column, F.lit(yes)).when(~column, F.lit(no))
        elif f.name == "days_employed":
            column = F.coalesce(column, F.lit(365243)).cast("string")
        return column.cast("string").alias(RAW_NAMES.get((file, f.name), f.name.upper()))

    return df.select(*[as_text(f) for f in df.schema.fields])
