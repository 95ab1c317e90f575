"""Delinquency migration: contract timelines as month intervals, aging, roll rates.

A contract's state (instalments paid, oldest unpaid due date) changes only at its own
events, so it is kept as month intervals instead of a contract x month grid. Intervals
are built per contract after the instalments were added up per contract and dates, which
bounds the rows any contract brings to a window by the calendar, however many
instalments it owns. Months are expanded last: balances from their changes, added up
before, anything else right before a partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vintora.functions.calendar import ceil_month, dpd_bucket, floor_month, month_range, year_month
from vintora.functions.numbers import cents, from_cents
from vintora.operators.portfolio import book_totals
from vintora.params import BUCKETS, LTM_LABEL, ROLLS, Params

ONE_MONTH = 1


def last_month(p: Params) -> Column:
    return F.lit(p.snapshot.replace(day=1))


def first_month(loans: DataFrame) -> Column:
    """First day of the earliest known vintage, as a scalar subquery."""
    return book_totals(loans).select("primeiro_mes").scalar()


def spine_rows(totals: DataFrame, p: Params) -> DataFrame:
    return totals.select(F.explode(month_range(F.col("primeiro_mes"), last_month(p))).alias("cal"))


def month_spine(loans: DataFrame, p: Params) -> DataFrame:
    """Every first-of-month from the earliest vintage to the snapshot."""
    return spine_rows(book_totals(loans), p)


def dated(inst: DataFrame) -> DataFrame:
    return inst.where(F.col("data_vencimento").isNotNull() & F.col("id_contrato").isNotNull())


def contract_event_bounds(inst: DataFrame) -> DataFrame:
    """First due date and first event (due or payment) per contract."""
    due, paid = F.col("data_vencimento"), F.col("data_pagamento")
    return (
        dated(inst)
        .groupBy("id_contrato")
        .agg(F.min(due).alias("min_venc"), F.min(F.least(due, F.coalesce(paid, due))).alias("min_event"))
    )


def contract_bounds(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Contracts with instalments and the months their timeline covers."""
    lo = F.greatest(floor_month(F.col("min_event")), first_month(loans))
    terms = loans.select("id_contrato", "pmt", "num_parcelas")
    return (
        terms.join(contract_event_bounds(inst), "id_contrato")
        .withColumn("lo", lo)
        .withColumn("hi", last_month(p))
        .where("lo <= hi")
    )


def contract_month_grid(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Contract x month rows from the first event to the snapshot."""
    return contract_bounds(loans, inst, p).select(
        "id_contrato", F.explode(month_range(F.col("lo"), F.col("hi"))).alias("cal")
    )


def payment_effective_month(inst: DataFrame) -> DataFrame:
    """Payments per contract and the first first-of-month on or after the payment."""
    return (
        dated(inst)
        .where(F.col("data_pagamento").isNotNull())
        .groupBy("id_contrato", ceil_month(F.col("data_pagamento")).alias("cal"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cumulative_payments(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Instalments paid so far for every contract x month.

    Payments before the earliest vintage are outside the calendar and not counted.
    """
    start, end = first_month(loans), last_month(p)
    bounds = contract_bounds(loans, inst, p).select("id_contrato", F.col("lo").alias("cal"), F.lit(0).cast("bigint").alias("n"))
    paid = (
        payment_effective_month(inst)
        .where(F.col("cal").between(start, end))
        .join(loans.select("id_contrato"), "id_contrato", "left_semi")
    )
    by_month = Window.partitionBy("id_contrato").orderBy("cal", "n")
    following = F.coalesce(F.lead("cal").over(by_month), F.add_months(end, ONE_MONTH))
    runs = bounds.unionByName(paid).select(
        "id_contrato",
        "cal",
        F.sum("n").over(by_month.rowsBetween(Window.unboundedPreceding, 0)).alias("pagas"),
        F.add_months(following, -ONE_MONTH).alias("ate"),
    )
    return runs.select("id_contrato", F.explode(month_range(F.col("cal"), F.col("ate"))).alias("cal"), "pagas")


def contract_events(inst: DataFrame, p: Params) -> DataFrame:
    """Instalments per contract, due date and effective payment month.

    ``ate`` is the last month an instalment stayed unpaid and ``n`` the payments. The
    map-side aggregation leaves a contract at most one row per pair of dates and task.
    """
    paid_month = ceil_month(F.col("data_pagamento"))
    return (
        dated(inst)
        .groupBy("id_contrato", F.col("data_vencimento").alias("venc"), paid_month.alias("mes_pago"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("ate", F.coalesce(F.add_months("mes_pago", -ONE_MONTH), last_month(p)))
    )


def overdue_runs(events: DataFrame, start: Column, p: Params) -> DataFrame:
    """Adds to every event the months for which its due date is the oldest unpaid one.

    Due dates are taken in order. An earlier date that is still unpaid hides a later
    one, so a date rules only the months after the latest month any earlier date stayed
    unpaid. The resulting runs ``lo..hi`` of one contract never overlap.
    """
    earlier = Window.partitionBy("id_contrato").orderBy("venc", "ate").rowsBetween(Window.unboundedPreceding, -1)
    visible_from = F.add_months("oculto_ate", ONE_MONTH)
    return events.withColumn("oculto_ate", F.max("ate").over(earlier)).withColumns(
        {
            "primeiro": F.col("oculto_ate").isNull(),
            "lo": F.greatest(ceil_month(F.col("venc")), start, visible_from),
            "hi": F.least(F.col("ate"), last_month(p)),
        }
    )


def oldest_unpaid_due(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Oldest due and unpaid date for every contract x month that has one."""
    runs = overdue_runs(contract_events(inst, p), first_month(loans), p).where("lo <= hi")
    return runs.select(
        "id_contrato",
        F.explode(month_range(F.col("lo"), F.col("hi"))).alias("cal"),
        F.col("venc").alias("min_unpaid_due"),
    )


def contract_states(inst: DataFrame, start: Column, p: Params) -> DataFrame:
    """Month intervals with constant instalments paid and oldest unpaid due date.

    Covers each contract from its first due month to the snapshot. The two windows and
    the later join all cluster by contract, so one exchange serves them.
    """
    end = last_month(p)
    clear = F.lit("9999-12-31").cast("date")

    def change(when: Column, month: Column, order: int, n: Column, oldest: Column, opens: bool) -> Column:
        row = F.struct(
            month.alias("cal"),
            F.lit(order).alias("ordem"),
            n.cast("bigint").alias("n"),
            oldest.cast("date").alias("mais_antiga"),
            F.lit(opens).alias("abre"),
        )
        return F.when(when, row)

    none, zero = F.lit(None), F.lit(0)
    overdue = F.col("lo") <= F.col("hi")
    changes = F.array(
        change(F.col("primeiro"), F.greatest(ceil_month(F.col("venc")), start), 0, zero, none, True),
        change(overdue, F.add_months("hi", ONE_MONTH), 1, zero, clear, False),
        change(overdue, F.col("lo"), 2, zero, F.col("venc"), False),
        change(F.col("mes_pago").between(start, end), F.col("mes_pago"), 3, F.col("n"), none, False),
    )
    timeline = Window.partitionBy("id_contrato").orderBy("cal", "ordem")
    so_far = timeline.rowsBetween(Window.unboundedPreceding, 0)
    following = F.coalesce(F.lead("cal").over(timeline), F.add_months(end, ONE_MONTH))
    oldest = F.last("mais_antiga", ignorenulls=True).over(so_far)
    return (
        overdue_runs(contract_events(inst, p), start, p)
        .select("id_contrato", F.inline(changes))
        .where("ordem IS NOT NULL")
        .select(
            "id_contrato",
            F.col("cal").alias("de"),
            F.least(F.add_months(following, -ONE_MONTH), end).alias("ate"),
            F.sum("n").over(so_far).alias("pagas"),
            F.nullif(oldest, clear).alias("mais_antiga"),
            F.bool_or("abre").over(so_far).alias("aberto"),
        )
        .where("aberto and de <= ate")
        .drop("aberto")
    )


def balance_states(loans: DataFrame, inst: DataFrame, p: Params, start: Column | None = None) -> DataFrame:
    """Contract states with the outstanding balance in cents."""
    start = first_month(loans) if start is None else start
    terms = loans.select("id_contrato", cents(F.col("pmt")).alias("pmt_c"), "num_parcelas")
    left = F.greatest(F.col("num_parcelas") - F.col("pagas"), F.lit(0))
    return (
        contract_states(inst, start, p)
        .join(terms, "id_contrato")
        .withColumn("saldo_c", F.col("pmt_c") * left)
    )


def month_bucket() -> Column:
    """Bucket of an expanded month against the oldest unpaid due date."""
    oldest = F.col("mais_antiga")
    return F.when(oldest.isNull(), "corrente").otherwise(dpd_bucket(F.datediff("cal", oldest)))


def outstanding_balance_bucket(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Outstanding balance and delinquency bucket of every contract x month."""
    months = F.explode(month_range(F.col("de"), F.col("ate"))).alias("cal")
    return (
        balance_states(loans, inst, p)
        .select("id_contrato", months, "saldo_c", "mais_antiga")
        .select("id_contrato", "cal", from_cents(F.col("saldo_c")).alias("saldo"), month_bucket().alias("bucket"))
    )


def aging_cells(loans: DataFrame, inst: DataFrame, p: Params, start: Column | None = None) -> DataFrame:
    """Cents of balance per month and bucket; contracts without balance are left out.

    An interval adds its balance in its first month and takes it away after its last. These changes are added up by oldest
    unpaid due date and month, so only sums that the calendar bounds are expanded to months, not the intervals of contracts.
    """

    def change(month: Column, cents: Column) -> Column:
        return F.struct(month.alias("cal"), cents.alias("mudanca_c"))

    opens = change(F.col("de"), F.col("saldo_c"))
    closes = change(F.add_months("ate", ONE_MONTH), -F.col("saldo_c"))
    changes = (
        balance_states(loans, inst, p, start)
        .where("saldo_c <> 0")
        .select("mais_antiga", F.inline(F.array(opens, closes)))
        .groupBy("mais_antiga", "cal")
        .agg(F.sum("mudanca_c").alias("mudanca_c"))
    )
    by_month = Window.partitionBy("mais_antiga").orderBy("cal")
    so_far = F.sum("mudanca_c").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
    last = F.add_months(F.lead("cal").over(by_month), -ONE_MONTH)
    months = F.explode(month_range(F.col("de"), F.col("ate"))).alias("cal")
    return (
        changes.select("mais_antiga", F.col("cal").alias("de"), last.alias("ate"), so_far.alias("saldo_c"))
        .where("ate IS NOT NULL")
        .select(months, "saldo_c", "mais_antiga")
        .groupBy("cal", month_bucket().alias("bucket"))
        .agg(F.sum("saldo_c").alias("saldo_c"))
    )


def aging_from_cells(cells: DataFrame, spine: DataFrame) -> DataFrame:
    """One row per month with a column per bucket, absent cells filled with zero."""
    wide = cells.groupBy("cal").pivot("bucket", list(BUCKETS)).agg(F.sum("saldo_c"))
    return spine.join(wide, "cal", "left").select(
        "cal",
        year_month(F.col("cal")).alias("mes"),
        *[from_cents(F.coalesce(F.col(b), F.lit(0))).alias(b) for b in BUCKETS],
    )


def aging_balance(loans: DataFrame, inst: DataFrame, p: Params) -> DataFrame:
    """Outstanding balance by month and delinquency bucket over the whole calendar."""
    return aging_from_cells(aging_cells(loans, inst, p), month_spine(loans, p))


def roll_rates(aging: DataFrame) -> DataFrame:
    """Share of a bucket that moved to the next one since the previous month.

    Works on the monthly totals, one row per calendar month.
    """
    by_month = Window.orderBy("cal")

    def previous(bucket: str) -> Column:
        return F.lag(bucket).over(by_month)

    def share(amount: Column, bucket: str) -> Column:
        before = previous(bucket)
        return F.when(before > 0, amount / before)

    rates = {name: share(F.col(num), den) for name, num, den in ROLLS}
    rates["r180p"] = share(F.col("f180p") - previous("f180p"), "f151_180")
    return (
        aging.select("cal", "mes", *[c.alias(n) for n, c in rates.items()], F.lag("cal").over(by_month).alias("_antes"))
        .where(F.col("_antes").isNotNull())
        .drop("_antes")
    )


CHAIN90 = ("r91_120", "r121_150", "r151_180", "r180p")
CHAIN60 = ("r61_90",) + CHAIN90
ROLL_COLUMNS = tuple(r[0] for r in ROLLS) + ("r180p",)
EFFICIENCIES = ("effic60", "effic90")


def chain_efficiency(rolls: DataFrame) -> DataFrame:
    """Product of consecutive rolls; null when any of them is null."""

    def product(names) -> Column:
        out = F.col(names[0])
        for n in names[1:]:
            out = out * F.col(n)
        return out

    return rolls.withColumns({"effic60": product(CHAIN60), "effic90": product(CHAIN90)})


def ltm_averages(rolls: DataFrame, p: Params) -> DataFrame:
    """One row of means over the last twelve monthly rows with both efficiencies.

    Rolls are averaged from their five-decimal percentage; r180p is not averaged.
    """
    latest = Window.orderBy(F.desc("cal"))
    window = (
        rolls.withColumn("_rn", F.row_number().over(latest))
        .where(F.col("_rn") <= p.ltm_rows)
        .where(F.col("effic60").isNotNull() & F.col("effic90").isNotNull())
    )
    five = {n: F.round((F.col(n) * 100).cast("decimal(38,10)"), 5).cast("double") for n, _, _ in ROLLS}
    return window.agg(
        *[F.avg(c).alias(f"{n}_pct") for n, c in five.items()],
        *[F.coalesce(F.avg(e), F.lit(0.0)).alias(e) for e in EFFICIENCIES],
        F.count(F.lit(1)).alias("meses"),
    )


def roll_table(rolls: DataFrame, ltm: DataFrame) -> DataFrame:
    """Monthly rolls in percent followed by the LTM mean row."""
    monthly = rolls.select(
        "mes", *[(F.col(c) * 100).alias(c) for c in ROLL_COLUMNS + EFFICIENCIES], F.lit(5).alias("decimais")
    )
    mean = ltm.select(
        F.lit(LTM_LABEL).alias("mes"),
        *[F.col(f"{n}_pct").alias(n) for n, _, _ in ROLLS],
        F.lit(None).cast("double").alias("r180p"),
        *[(F.col(e) * 100).alias(e) for e in EFFICIENCIES],
        F.lit(2).alias("decimais"),
    )
    both = monthly.unionByName(mean)
    exact = {
        c: F.when(F.col("decimais") == 5, F.round(F.col(c).cast("decimal(38,10)"), 5).cast("double")).otherwise(
            F.round(F.col(c).cast("decimal(38,10)"), 2).cast("double")
        )
        for c in ROLL_COLUMNS + EFFICIENCIES
    }
    return both.withColumns(exact).drop("decimais").orderBy("mes")
