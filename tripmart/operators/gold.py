"""Zone-by-day mart and its roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import TripContract
from tripmart.functions.exact import LIMBS, carried, from_units, ratio_half_up, units, with_unit_limbs


def trust_score(flagged: Column, trips: Column) -> Column:
    """Share of consistent trips in percent; null without counted trips.

    ``trips`` counts rows with a vendor, ``flagged`` all rows, so the score
    can be negative where many rows have no vendor.
    """
    return ratio_half_up(trips - flagged, trips, factor=100)


def tip_efficiency(tip_cents: Column, fare_cents: Column) -> Column:
    """Tips in percent of fares; 0 where fares do not add up to more than 0."""
    share = ratio_half_up(tip_cents, fare_cents, factor=100)
    return F.when(fare_cents > 0, share).otherwise(F.lit(0))


def zone_day(silver: DataFrame, contract: TripContract = TripContract()) -> DataFrame:
    """Daily metrics per pickup zone, with ``year`` and ``month`` keys.

    All aggregates are sums and counts of whole numbers, so they are combined
    before the shuffle: a zone-day with most of the trips costs one row per
    task, and the result does not depend on the order of the rows.  Distances
    are summed with all their decimals, so their mean is rounded once.
    """
    limbs = [f"distance_{i}" for i in range(1 + LIMBS)]
    seconds = F.rint(F.col("trip_duration_minutes") * 60).cast("bigint")
    sums = with_unit_limbs(silver, "trip_distance", limbs).groupBy(
        F.to_date("tpep_pickup_datetime").alias("pickup_date"), F.col("PULocationID")
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("VendorID").alias("total_trips"),
        F.count_if(~F.col("is_total_correct")).alias("flagged_incorrect_trips"),
        F.sum(units(F.col("total_amount"))).alias("total_c"),
        F.count("total_amount").alias("total_n"),
        F.sum(units(F.col("tip_amount"))).alias("tip_c"),
        F.sum(units(F.col("fare_amount"))).alias("fare_c"),
        *[F.sum(name).alias(name) for name in limbs],
        F.count("trip_distance").alias("distance_n"),
        F.sum("passenger_count").alias("total_passengers_transported"),
        F.sum(seconds).alias("seconds"),
        F.count("trip_duration_minutes").alias("seconds_n"),
    )
    return sums.select(
        "pickup_date",
        "PULocationID",
        "row_count",
        "total_trips",
        "flagged_incorrect_trips",
        from_units(F.col("total_c")).alias("total_revenue"),
        ratio_half_up(F.col("total_c"), F.col("total_n") * 100).alias("avg_revenue"),
        from_units(F.col("tip_c")).alias("total_tips_profit"),
        tip_efficiency(F.col("tip_c"), F.col("fare_c")).cast("double").alias("tip_efficiency_pct"),
        ratio_half_up(carried([F.col(name) for name in limbs]), F.col("distance_n") * 10**4)
        .cast("double")
        .alias("avg_distance"),
        "total_passengers_transported",
        ratio_half_up(F.col("seconds"), F.col("seconds_n") * 60)
        .cast("double")
        .alias("avg_duration_minutes"),
        trust_score(F.col("flagged_incorrect_trips"), F.col("total_trips"))
        .cast("double")
        .alias("data_trust_score"),
        F.year("pickup_date").alias("year"),
        F.month("pickup_date").alias("month"),
    )


def report_order(gold: DataFrame) -> DataFrame:
    """Newest day first, busiest zone first; for reading, not for writing."""
    return gold.orderBy(F.desc("pickup_date"), F.desc("total_trips"), "PULocationID")


def rollup(gold: DataFrame) -> DataFrame:
    """Totals and trust per month, per zone, per both, and overall, in one pass."""
    month = (F.col("year") * 100 + F.col("month")).alias("month_key")
    base = gold.select(
        month,
        F.col("PULocationID").alias("zone"),
        "total_trips",
        "flagged_incorrect_trips",
        units(F.col("total_revenue")).alias("revenue_c"),
        units(F.col("total_tips_profit")).alias("tips_c"),
    )
    sets = [["month_key", "zone"], ["month_key"], ["zone"], []]
    summed = base.groupingSets(
        [[F.col(c) for c in s] for s in sets], F.col("month_key"), F.col("zone")
    ).agg(
        F.grouping_id().alias("grain_id"),
        F.sum("total_trips").alias("total_trips"),
        F.sum("flagged_incorrect_trips").alias("flagged_incorrect_trips"),
        F.sum("revenue_c").alias("revenue_c"),
        F.sum("tips_c").alias("tips_c"),
    )
    grain = (
        F.when(F.col("grain_id") == 0, "month_zone")
        .when(F.col("grain_id") == 1, "month")
        .when(F.col("grain_id") == 2, "zone")
        .otherwise("total")
    )
    return summed.select(
        grain.alias("grain"),
        "month_key",
        "zone",
        "total_trips",
        "flagged_incorrect_trips",
        from_units(F.col("revenue_c")).alias("total_revenue"),
        from_units(F.col("tips_c")).alias("total_tips_profit"),
        trust_score(F.col("flagged_incorrect_trips"), F.col("total_trips"))
        .cast("double")
        .alias("data_trust_score"),
    )
