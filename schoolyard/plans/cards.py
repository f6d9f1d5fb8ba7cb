"""Dashboard queries over the two reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schoolyard import functions as fn


def _total(c: str) -> Column:
    return fn.exact_sum(c)


def _rate(times: int = 1) -> Column:
    """Successful among all deliveries; NULL where there were none."""
    total = F.sum("total_deliveries")
    return F.when(total > 0, F.sum("successful_deliveries").cast("double") * times / total)


def _listed(months: DataFrame, found: DataFrame, zeros: Sequence[str]) -> DataFrame:
    """Every month of the list (a row each) with what was found in it; sums are 0 otherwise."""
    every = months.join(found, "month", "left")
    return every.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(found.schema[c].dataType)) for c in zeros}
    )


# The cards add up school-month facts, of which there are far fewer than schools x months: a
# school and month without any would only add zeros.


def kpis(ytd: DataFrame) -> DataFrame:
    """Ordered amount, schools served (summed over managers) and contracts."""
    return ytd.agg(
        _total("ordered_amount").alias("ordered_amount"),
        F.sum("total_schools_served").alias("schools_served"),
        F.sum("total_contracts").alias("active_contracts"),
    )


def delivery_rate(facts: DataFrame) -> DataFrame:
    return facts.agg(_rate().alias("delivery_success_rate"))


def monthly_amount(facts: DataFrame, months: DataFrame) -> DataFrame:
    found = facts.groupBy("month").agg(_total("ordered_amount").alias("ordered_amount"))
    return _listed(months, found, ["ordered_amount"])


def monthly_orders(facts: DataFrame, months: DataFrame) -> DataFrame:
    counts = ["active_orders", "cancelled_orders"]
    found = facts.groupBy("month").agg(*[F.sum(c).alias(c) for c in counts])
    return _listed(months, found, counts)


def monthly_delivery_rate(facts: DataFrame, months: DataFrame) -> DataFrame:
    return _listed(months, facts.groupBy("month").agg(_rate(100).alias("delivery_rate_pct")), [])


def monthly_tickets(facts: DataFrame, months: DataFrame) -> DataFrame:
    found = facts.groupBy("month").agg(F.sum("total_tickets").alias("total_tickets"))
    return _listed(months, found, ["total_tickets"])


def _per_school(
    facts: DataFrame, schools: DataFrame, months: DataFrame, total: Column, columns: Sequence[str]
) -> DataFrame:
    """Every school with a total over its facts, 0 without any; none if there is no month."""
    found = facts.groupBy("school_id").agg(total.alias("total"))
    listed = schools.filter(F.size(months.scalar()) > 0).select("school_id", *columns)
    filled = F.coalesce("total", F.lit(0).cast(found.schema["total"].dataType))
    return listed.join(found, "school_id", "left").withColumn("total", filled)


def state_volume(facts: DataFrame, schools: DataFrame, months: DataFrame) -> DataFrame:
    """Units delivered by the state of the school; ``months`` is the row of active months."""
    sums = _per_school(facts, schools, months, F.sum("quantity_delivered"), ["state"])
    return (
        sums.groupBy("state")
        .agg(F.sum("total").alias("quantity_delivered"))
        .orderBy(F.desc("quantity_delivered"), "state")
    )


def resolution_time(tickets: DataFrame, year: DataFrame) -> DataFrame:
    """Mean hours to resolve over the tickets of the reference year."""
    hours = fn.elapsed_hours("created_at", "solved_at")
    return tickets.filter(fn.in_year("created_at", year.scalar())).agg(
        F.avg(hours).alias("avg_resolution_hours")
    )


def portfolio(ytd: DataFrame) -> DataFrame:
    return ytd.select(
        F.col("account_manager_name").alias("account_manager"),
        F.col("total_schools_served").alias("escolas_atendidas"),
        F.col("ordered_amount").alias("valor_pedido_brl"),
        F.col("total_orders").alias("pedidos"),
        F.col("total_contracts").alias("contratos"),
        F.col("total_tickets").alias("tickets"),
        F.col("avg_resolution_hours").alias("resolucao_media_horas"),
    )


def manager_ranking(ytd: DataFrame) -> DataFrame:
    return ytd.select("account_manager_id", "account_manager_name", "ordered_amount").orderBy(
        F.desc("ordered_amount"), "account_manager_id"
    )


def top_schools(facts: DataFrame, schools: DataFrame, months: DataFrame, n: int = 10) -> DataFrame:
    """Schools with the highest accumulated amount; ties go to the lower id."""
    names = schools.withColumnRenamed("name", "school_name")
    return (
        _per_school(facts, names, months, _total("ordered_amount"), ["school_name"])
        .select("school_id", "school_name", F.col("total").alias("ordered_amount"))
        .orderBy(F.desc("ordered_amount"), "school_id")
        .limit(n)
    )


def board(facts: DataFrame, schools: DataFrame, months: DataFrame) -> DataFrame:
    """The measures of all cards in one pass: by month, by state, by school, and in total.

    Facts meet the states of their schools once and are grouped by each set of keys. Every
    school and every month adds a row without measures, so that none is missing.
    """
    sums = ["active_orders", "cancelled_orders", "quantity_delivered", "total_tickets"]
    kinds = {f.name: f.dataType for f in facts.schema}
    measures = ["ordered_amount", *sums, "total_deliveries", "successful_deliveries"]

    def bare(school: Column, state: Column, month: Column) -> list[Column]:
        none = [F.lit(None).cast(kinds[m]).alias(m) for m in measures]
        return [school.alias("school_id"), state.alias("state"), month.alias("month"), *none]

    null = F.lit(None)
    any_month = F.size(months.scalar()) > 0
    places = schools.filter(any_month).select("school_id", "state")
    rows = (
        facts.select("school_id", "month", *measures)
        .join(places, "school_id")
        .select("school_id", "state", "month", *measures)
        .unionByName(places.select(*bare(F.col("school_id"), F.col("state"), null.cast("date"))))
        .unionByName(
            months.select(F.explode("months").alias("month"))
            .filter(places.limit(1).agg(F.count(F.lit(1))).scalar() > 0)
            .select(*bare(null.cast("string"), null.cast("string"), F.col("month")))
        )
    )
    card = F.when(F.grouping("month") == 0, "month").when(F.grouping("state") == 0, "state").when(
        F.grouping("school_id") == 0, "school"
    )
    grouped = rows.groupingSets([["month"], ["state"], ["school_id"], []], "month", "state", "school_id").agg(
        F.coalesce(card, F.lit("all")).alias("card"),
        F.coalesce(F.col("month").cast("string"), "state", "school_id").alias("key"),
        fn.exact_total("ordered_amount").alias("_amount"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        _rate(100).alias("delivery_rate_pct"),
        F.count(F.when(F.col("school_id").isNotNull(), 1)).alias("_schools"),
        F.count("month").alias("_months"),
    )
    # rows without a month or without a school belong to no such group
    own = F.when(F.col("card") == "month", F.col("key").isNotNull()).when(
        F.col("card") == "school", F.col("key").isNotNull()
    ).otherwise(F.col("_schools") > 0)
    amount = F.coalesce("_amount", F.lit(0.0)).alias("ordered_amount")
    return fn.with_rounded(grouped.filter(own), "_amount").select(
        "card", "key", amount, *sums, "delivery_rate_pct"
    )


def _number(date: Column) -> Column:
    """Months since the year 0."""
    return F.year(date) * 12 + F.month(date)


def trailing_year(facts: DataFrame, schools: DataFrame, months: DataFrame) -> DataFrame:
    """Each school's evolution: the last 12 months up to each month, and a year before.

    The trailing sum of a school changes where a month with facts enters the window and where it
    leaves it a year later. These events, at most two for each fact, are put in order by school;
    each gives the sums that hold until the next: what entered so far without what left, which is
    exact, as totals are. Only then is a row made for every listed month
    an event covers, so what is shuffled and sorted follows the facts and not schools x months.
    Months are counted on the calendar: one in which nobody did anything does not stretch a year.
    """
    number = _number(F.col("month"))
    orders = F.col("total_orders")
    none = F.lit(None)

    def event(no: Column, known: bool, **sums: Column) -> Column:
        """What enters and what leaves; sums not given are NULL."""
        kinds = {"amount": "double", "orders": "bigint", "left_amount": "double", "left_orders": "bigint"}
        filled = [sums.get(c, none).cast(kind).alias(c) for c, kind in kinds.items()]
        return F.struct(no.alias("no"), *filled, F.lit(known).alias("known"))

    # the list, each month with its number and whether the month a year before is listed as well,
    # and, for each month of the calendar it spans and a year on, how many come before
    first, last = _number(F.get("months", F.lit(0))), _number(F.get("months", F.size("months") - 1))
    numbers = F.transform("months", _number)
    before = F.transform(
        F.sequence(first - 12, last + 13), lambda n: F.size(F.filter(numbers, lambda m: m < n))
    )
    told = F.transform(
        "months",
        lambda m: F.struct(
            m.alias("month"),
            _number(m).alias("no"),
            F.array_contains(numbers, _number(m) - 12).alias("listed_then"),
        ),
    )
    calendar = (
        months.filter(F.size("months") > 0)
        .select(F.struct(told.alias("months"), (first - 12).alias("start"), before.alias("before")).alias("c"))
        .scalar()
    )
    amount = F.col("ordered_amount")
    both = F.array(
        event(number, False, amount=amount, orders=orders),
        event(number + 12, False, left_amount=amount, left_orders=orders),
    )
    listed = event(calendar["start"] + 12, True)
    # one pass over the facts makes both of their events
    events = facts.select("school_id", F.inline(both)).unionByName(
        schools.select("school_id", F.inline(F.array(listed))).filter("no IS NOT NULL")
    )
    # a school and month have one fact at most: one enters there and one leaves
    settled = events.groupBy("school_id", "no").agg(
        *[F.max(c).alias(c) for c in ("amount", "orders", "left_amount", "left_orders")],
        F.bool_or("known").alias("known"),
    )
    # sorted by a number, as ids may begin alike
    parts = [F.xxhash64("school_id"), F.col("school_id")]
    school = Window.partitionBy(*parts).orderBy("no")
    so_far = school.rowsBetween(Window.unboundedPreceding, 0)
    nought = F.lit(0).cast("bigint")
    # moved as doubles, which are a third of the size of totals
    swept = settled.repartition("school_id").select(
        "*", fn.exact("amount").alias("enters"), fn.exact("left_amount").alias("leaves")
    ).select(
        "school_id",
        "no",
        F.col("enters").alias("own"),
        F.col("leaves").alias("year_ago"),
        fn.running_difference(
            F.col("enters"), F.col("leaves"), so_far, school.rangeBetween(-11, 0)
        ).alias("trailing"),
        F.sum(F.coalesce("orders", nought) - F.coalesce("left_orders", nought)).over(so_far).alias("trailing_orders"),
        F.lead("no").over(school).alias("until"),
        F.max("known").over(Window.partitionBy(*parts)).alias("known"),
    ).filter("known")
    swept = fn.with_rounded(swept.drop("known"), "own", "trailing", "year_ago")

    def place(no: Column) -> Column:
        """How many listed months come before a calendar month."""
        return F.get(calendar["before"], no - calendar["start"])

    size = F.size(calendar["months"])
    begin, end = place(F.col("no")), F.coalesce(place(F.col("until")), size)
    dense = swept.filter(begin < end).withColumn(
        "_month", F.explode(F.slice(calendar["months"], begin + 1, end - begin))
    )
    here = F.col("_month.no") == F.col("no")

    def or_none(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0))

    return dense.select(
        "school_id",
        "_month.month",
        F.when(here, or_none("own")).otherwise(0.0).alias("ordered_amount"),
        or_none("trailing").alias("trailing_amount"),
        "trailing_orders",
        F.when(F.col("_month.listed_then"), F.when(here, or_none("year_ago")).otherwise(0.0)).alias("year_ago_amount"),
    )


def filter_metrics(
    monthly: DataFrame,
    month_from: dt.date | None = None,
    month_to: dt.date | None = None,
    state: str | None = None,
    school: str | None = None,
) -> DataFrame:
    """The dashboard's global filters; a filter that is not given does nothing."""
    out = monthly
    if month_from is not None:
        out = out.filter(F.col("month") >= F.lit(month_from))
    if month_to is not None:
        out = out.filter(F.col("month") <= F.lit(month_to))
    if state is not None:
        out = out.filter(F.col("state") == state)
    if school is not None:
        out = out.filter(F.col("school_name") == school)
    return out


def trend(facts: DataFrame, months: DataFrame) -> DataFrame:
    """The measures of the trend cards, month by month."""
    counts = ["active_orders", "cancelled_orders", "total_tickets"]
    found = facts.groupBy("month").agg(
        _total("ordered_amount").alias("ordered_amount"),
        *[F.sum(c).alias(c) for c in counts],
        _rate(100).alias("delivery_rate_pct"),
    )
    return _listed(months, found, ["ordered_amount", *counts])
