"""Portfolio analytics: default rates, segment lift, behaviour segments and correlations.

Every function reads one wide ``portfolio`` table once: a row per labelled application with its
dimension attributes.  Where the table is made it is checked that a client has one row (``portfolio``,
and the star's numbering).  Reports that are told so (``unique``) count rows, which combines on the map
side, and shuffle no row for its client; others count distinct clients.  Totals of the portfolio are
added up from the groups of the same scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import aggs, display, rows
from ..operators.attach import attach
from ..operators.keys import require_unique
from . import gold

CLIENT = gold.CLIENT


# --- the wide base --------------------------------------------------------------------------


@dataclass(frozen=True)
class Star:
    """The published star.  Its tables hold every client once, since one numbering checked that."""

    fact: DataFrame
    requester: DataFrame
    risk_segment: DataFrame

    def base(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The wide base of a report: the fact and those dimensions that own one of ``columns``.

        A left join to a table with one row per client changes no other column, so a dimension that
        the report does not read is not joined; without ``columns`` all are.
        """
        joined = self.fact
        for dim in (self.requester, self.risk_segment):
            own = [c for c in dim.columns if c not in joined.columns and (columns is None or c in columns)]
            if own:
                joined = joined.join(dim.select(CLIENT, *own), CLIENT, "left")
        return joined


def portfolio_from_star(
    fact: DataFrame, requester: DataFrame, risk_segment: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Fact with requester and risk attributes, joined on the client id that every key stands for."""
    return Star(fact, requester, risk_segment).base(columns)


def portfolio(
    applications: DataFrame,
    internal: DataFrame,
    external: DataFrame,
    rules: Sequence[Row],
    check: bool = True,
) -> DataFrame:
    """The same table straight from silver: labelled applications and two client roll-ups.

    One join per history instead of the star's join per table; a query keeps only the columns
    and aggregates it uses.  ``check`` raises if a client has two labelled applications; it reads the
    key column only.
    """
    labelled = applications.where(~F.col("flag_test"))
    if check:
        require_unique(labelled.select(CLIENT), CLIENT)
    base = labelled.withColumns(
        {**gold.requester_bands(rules), **gold.risk_bands(rules)}
    )
    wanted = dict.fromkeys(
        [CLIENT, *gold.FACT_APPLICATION_COLUMNS, *gold.REQUESTER_COLUMNS,
         "mean_score_band", "annuity_income_band"]
    )
    base = base.select(*wanted)

    def both(rollup: DataFrame) -> DataFrame:
        names = {
            c: c.split("__", 1)[1] for c in rollup.columns if c.startswith(("fact__", "segment__"))
        }
        return rollup.select(CLIENT, *names).withColumnsRenamed(names)

    joined = attach(base, both(external), CLIENT, gold.NO_BUREAU)
    return attach(joined, both(internal), CLIENT, gold.NO_PREVIOUS)


# --- portfolio figures ----------------------------------------------------------------------


# Columns that each report reads, for a base that joins no more than these need
REPORT_COLUMNS = {
    "portfolio_kpis": [CLIENT, "target", "amt_credit", "prev_applications_approved", "prev_applications_total"],
    "default_split": ["target"],
    "profile_distribution": [CLIENT, "target", "amt_income_total", *vocab.PROFILE_AXES.values()],
    "segment_lift": [CLIENT, "target", "code_gender", "age_band", "income_band"],
    "dti_lift": ["target", "income_band", "annuity_income_band"],
    "behavior_segments": [CLIENT, "target", "amt_credit", *(column for _, _, column, _ in vocab.BEHAVIOR_SEGMENTS)],
    "target_correlation": [
        "target", *vocab.COMPLETENESS_PROXY, *(column for _, column, _ in vocab.CORRELATION_VARIABLES),
    ],
}


def _clients(unique: bool) -> Column:
    return aggs.rows() if unique else F.count_distinct(CLIENT)


def _defaults() -> Column:
    return aggs.tally("target")


def _defaulted_amount() -> Column:
    return F.sum(F.when(F.col("target"), F.col("amt_credit")).otherwise(F.lit(0.0)))


def portfolio_kpis(base: DataFrame, unique: bool = False) -> DataFrame:
    return base.agg(
        _clients(unique).alias("n_total_loans"),
        F.sum("amt_credit").alias("total_credit_amount"),
        aggs.default_rate().alias("default_rate"),
        F.sum(F.when(F.col("target"), 1).otherwise(0)).alias("total_defaults"),
        _defaulted_amount().alias("default_credit_amount"),
        F.try_divide(
            F.sum("prev_applications_approved"), F.sum("prev_applications_total")
        ).alias("historical_approval_rate"),
    )


def default_split(base: DataFrame) -> DataFrame:
    """Default rate against the rest, as two rows."""
    rate = F.col("default_rate")
    parts = F.array(
        F.struct(F.lit(vocab.DEFAULT_SHARE).alias("categoria"), rate.alias("valor")),
        F.struct(F.lit(vocab.REST_SHARE).alias("categoria"), (F.lit(1.0) - rate).alias("valor")),
    )
    return base.agg(aggs.default_rate().alias("default_rate")).select(F.inline(parts))


def humanised_kpis(base: DataFrame, unique: bool = False) -> DataFrame:
    kpis = portfolio_kpis(base, unique)
    return kpis.select(
        display.human_number(F.col("n_total_loans")).alias("n_total_loans"),
        display.human_currency(F.col("total_credit_amount")).alias("total_credit_amount"),
        display.human_percent(F.col("default_rate")).alias("default_rate"),
        display.human_number(F.col("total_defaults")).alias("total_defaults"),
        display.human_currency(F.col("default_credit_amount")).alias("default_credit_amount"),
        display.human_percent(F.col("historical_approval_rate")).alias("historical_approval_rate"),
    )


def band_order(rules: DataFrame) -> DataFrame:
    """Band labels in display order, once per group."""
    return (
        rules.where(~F.col("band_label").isin(vocab.BANDS_OUTSIDE_ORDER))
        .groupBy("band_group", "band_label")
        .agg(F.min("band_order").alias("band_order"))
        .select("band_group", "band_order", "band_label")
        .orderBy("band_group", "band_order")
    )


# --- profile distributions ------------------------------------------------------------------


def profile_distribution(base: DataFrame, unique: bool = False) -> DataFrame:
    """Clients, default rate and mean income on every profile axis, from one scan."""
    values = {**{c: F.col(c) for c in vocab.PROFILE_AXES.values()}}
    values["code_gender"] = rows.relabel("code_gender", vocab.GENDER_LABELS, keep_others=False)
    axes = F.array(
        *[
            F.struct(
                F.lit(axis).alias("distribution_type"),
                F.coalesce(values[column], F.lit(vocab.UNKNOWN)).alias("bucket"),
            )
            for axis, column in vocab.PROFILE_AXES.items()
        ]
    )
    return (
        base.select(CLIENT, "target", "amt_income_total", F.inline(axes))
        .groupBy("distribution_type", "bucket")
        .agg(
            _clients(unique).alias("clients"),
            aggs.default_rate().alias("default_rate"),
            F.avg("amt_income_total").alias("avg_income"),
        )
        .orderBy("distribution_type", "bucket")
    )


def profile_reindexed(base: DataFrame, rules: DataFrame, unique: bool = False) -> DataFrame:
    """The banded axes laid out in band order; a band without clients shows as NULL."""
    groups = rules.sparkSession.createDataFrame(
        list(vocab.ORDERED_AXES.items()), "distribution_type string, band_group string"
    )
    layout = (
        band_order(rules)
        .join(F.broadcast(groups), "band_group")
        .withColumnRenamed("band_label", "bucket")
    )
    return (
        layout.join(profile_distribution(base, unique), ["distribution_type", "bucket"], "left")
        .select("distribution_type", "band_order", "bucket", "clients", "default_rate", "avg_income")
        .orderBy("distribution_type", "band_order")
    )


# --- lift -----------------------------------------------------------------------------------


def _of_all(total: Column) -> Column:
    """An aggregate over all groups of a report, a few hundred rows."""
    return total.over(Window.partitionBy())


def _baseline(defaults: str, labelled: str) -> Column:
    """Default rate of the whole portfolio from its groups."""
    return F.try_divide(_of_all(F.sum(defaults)), _of_all(F.sum(labelled)))


def _within_order(column: str) -> Column:
    """NOT IN semantics: a NULL band is dropped too."""
    return ~F.col(column).isin(vocab.BANDS_OUTSIDE_ORDER)


def segment_lift(
    base: DataFrame, min_clients: int = vocab.MIN_CLIENTS, unique: bool = False
) -> DataFrame:
    """Default rate and lift over gender, age band and income band, from one scan."""
    gender = F.col("code_gender")
    shown = (
        gender.isNotNull() & (gender != vocab.GENDER_UNKNOWN) & _within_order("age_band") & _within_order("income_band")
    )
    grouped = (
        base.groupBy(
            F.coalesce(shown, F.lit(False)).alias("__shown"),
            rows.relabel("code_gender", vocab.GENDER_LABELS, keep_others=True).alias("genero"),
            F.col("age_band").alias("faixa_idade"),
            F.col("income_band").alias("faixa_renda"),
        )
        .agg(_clients(unique).alias("clientes"), _defaults().alias("__defaults"), F.count("target").alias("__labelled"))
        .withColumn("__baseline", _baseline("__defaults", "__labelled"))
        .where(F.col("__shown") & (F.col("clientes") >= F.lit(min_clients)))
        .withColumn("taxa_inadimplencia", F.try_divide("__defaults", "__labelled"))
    )
    rate, baseline = F.col("taxa_inadimplencia"), F.col("__baseline")
    return (
        grouped.withColumn("lift_risco", F.try_divide(rate, baseline))
        .withColumn("lift_pp", rate - baseline)
        .drop("__baseline", "__shown", "__defaults", "__labelled")
        .orderBy(
            F.desc_nulls_last("lift_risco"), F.desc("clientes"),
            "genero", "faixa_idade", "faixa_renda",
        )
    )


def risk_buckets(lift: DataFrame) -> DataFrame:
    return lift.withColumns(
        {
            "lift_label": display.lift_label(F.col("lift_risco")),
            "risk_bucket": display.risk_bucket(F.col("lift_risco")),
        }
    )


def dti_lift(base: DataFrame) -> DataFrame:
    """Lift over income band and annuity/income band."""
    # Here an absent label counts as not defaulted, unlike in the portfolio's own rate.
    return (
        base.groupBy("income_band", "annuity_income_band")
        .agg(_defaults().alias("__defaults"), F.count("target").alias("__labelled"), aggs.rows().alias("__clients"))
        .withColumn("__baseline", _baseline("__defaults", "__labelled"))
        .where(_within_order("annuity_income_band"))
        .select(
            "income_band",
            "annuity_income_band",
            F.try_divide(F.try_divide("__defaults", "__clients"), F.col("__baseline")).alias("lift_inadimplencia"),
        )
        .orderBy("income_band", "annuity_income_band")
    )


def dti_lift_pivot(base: DataFrame, rules: DataFrame, rule_rows: Sequence[Row]) -> DataFrame:
    """``dti_lift`` as a matrix with rows and columns in band order."""
    ordered = sorted(
        (r for r in rule_rows if r.band_group == "annuity_income_band"), key=lambda r: r.band_order
    )
    columns = [r.band_label for r in ordered if r.band_label not in vocab.BANDS_OUTSIDE_ORDER]
    matrix = (
        dti_lift(base)
        .groupBy("income_band")
        .pivot("annuity_income_band", columns)
        .agg(F.first("lift_inadimplencia"))
    )
    layout = (
        band_order(rules)
        .where(F.col("band_group") == "income_band")
        .select("band_order", F.col("band_label").alias("income_band"))
    )
    return (
        layout.join(matrix, "income_band", "left")
        .select("band_order", "income_band", *columns)
        .orderBy("band_order")
    )


# --- behaviour segments ---------------------------------------------------------------------


def _membership(kind: str, column: str, limit: float | None) -> Column:
    value = F.col(column)
    if kind == "set":
        return rows.is_true(column)
    if kind == "unset":
        return ~rows.is_true(column)
    if kind == "known_low":
        return value < F.lit(limit)
    if kind == "low":
        return F.coalesce(value, F.lit(0.0)) < F.lit(limit)
    if kind == "many":
        return F.coalesce(value, F.lit(0)) >= F.lit(limit)
    raise ValueError(f"unknown segment kind {kind}")


# Stands for all clients among the segments
_PORTFOLIO = ""


def behavior_segments(
    base: DataFrame, min_clients: int = vocab.MIN_CLIENTS, unique: bool = False
) -> DataFrame:
    """Metrics of the overlapping behaviour segments.

    A client belongs to any number of segments, and to the portfolio as a whole.  Each row lists its
    own segments and is expanded to them inside the task that adds them up, so the base is scanned
    once whatever the number of segments, and one row per segment and task is shuffled.
    """
    labels = F.array_compact(
        F.array(
            F.lit(_PORTFOLIO),
            *[
                F.when(_membership(kind, column, limit), F.lit(label))
                for label, kind, column, limit in vocab.BEHAVIOR_SEGMENTS
            ],
        )
    )
    totals = F.struct(
        F.col("clientes").alias("clients"),
        "defaults",
        F.col("valor_emprestimos").alias("amount"),
        F.col("taxa_inadimplencia").alias("rate"),
    )
    whole = F.col("segmento") == _PORTFOLIO
    grouped = (
        base.select(CLIENT, "target", "amt_credit", F.explode(labels).alias("segmento"))
        .groupBy("segmento")
        .agg(
            _clients(unique).alias("clientes"),
            _defaults().alias("defaults"),
            F.sum("amt_credit").alias("valor_emprestimos"),
            aggs.default_rate().alias("taxa_inadimplencia"),
            _defaulted_amount().alias("valor_emprestimos_inadimplentes"),
        )
        .withColumn("__totals", _of_all(F.max(F.when(whole, totals))))
        .where(~whole & (F.col("clientes") >= F.lit(min_clients)))
    )
    rate, total = F.col("taxa_inadimplencia"), F.col("__totals")
    return grouped.select(
        "segmento",
        "clientes",
        "defaults",
        "valor_emprestimos",
        "taxa_inadimplencia",
        F.try_divide(rate, total["rate"]).alias("lift_risco"),
        (rate - total["rate"]).alias("lift_pp"),
        F.try_divide(F.col("clientes"), total["clients"]).alias("pct_clientes"),
        F.try_divide(F.col("defaults"), total["defaults"]).alias("pct_defaults"),
        F.try_divide(F.col("valor_emprestimos"), total["amount"]).alias("pct_valor_emprestimos"),
        "valor_emprestimos_inadimplentes",
    ).orderBy(*_segment_order())


def _segment_order() -> list[Column]:
    return [
        F.desc_nulls_last("lift_risco"), F.desc("defaults"), F.desc("valor_emprestimos"),
        F.asc("segmento"),
    ]


def top_behavior_segments(
    base: DataFrame,
    min_clients: int = vocab.MIN_CLIENTS,
    top: int = vocab.TOP_SEGMENTS,
    unique: bool = False,
) -> DataFrame:
    """The segments with the highest lift (a top-k report)."""
    return behavior_segments(base, min_clients, unique).orderBy(*_segment_order()).limit(top)


# --- correlations ---------------------------------------------------------------------------


def target_correlation(base: DataFrame) -> DataFrame:
    """Correlation of the label with every report variable, from one aggregate."""
    target = F.col("target").cast("double")
    proxy = "cadastral_completeness_rate"
    values = {
        column: rows.is_true(column).cast("double") if is_flag else F.col(column)
        for _, column, is_flag in vocab.CORRELATION_VARIABLES
        if column != proxy
    }
    values[proxy] = rows.mean_of_rates(vocab.COMPLETENESS_PROXY)
    wide = base.select(target.alias("target"), *[v.alias(c) for c, v in values.items()]).agg(
        *[
            aggs.safe_corr(F.col("target"), F.col(column)).alias(column)
            for _, column, _ in vocab.CORRELATION_VARIABLES
        ]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("variavel"), F.col(column).alias("correlacao"))
            for label, column, _ in vocab.CORRELATION_VARIABLES
        ]
    )
    return wide.select(F.inline(pairs))


def top_correlation(base: DataFrame, top: int = vocab.TOP_CORRELATIONS) -> DataFrame:
    """The variables with the strongest correlation (a top-k report)."""
    value = F.col("correlacao")
    return (
        target_correlation(base)
        .where(value.isNotNull() & ~F.isnan(value))
        .orderBy(F.abs(value).desc(), "variavel")
        .limit(top)
    )


def correlation_matrix(base: DataFrame, top: int = vocab.TOP_CORRELATIONS) -> DataFrame:
    """``top_correlation`` as one row with a column per report variable; others are NULL."""
    labels = [label for label, _, _ in vocab.CORRELATION_VARIABLES]
    return top_correlation(base, top).groupBy().pivot("variavel", labels).agg(F.first("correlacao"))
