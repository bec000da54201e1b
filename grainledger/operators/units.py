"""Pack sizes, unit agreement between two sources, and device clocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hours_since, round_to
from .medians import median_small_domain

# Labels of the unit conversion.
CONVERTED, UNKNOWN = "CONVERTED", "UNKNOWN"
FROM_REFERENCE, FROM_MASTER = "UOM_REFERENCE", "CDC_CASE_PACK"
EACH, CASE = "EA", "CS"


def to_eaches(qty: str, uom: str, factor: str, fallback: str) -> dict[str, Column]:
    """`conversion_status`, `conversion_source` and `eaches` of a quantity.

    One number decides all three: how many eaches one unit holds. Eaches hold one, cases hold the
    reference factor or else the master's case pack, anything else is unknown and stays NULL.
    """
    per_unit = F.when(F.col(uom) == EACH, F.lit(1)).when(
        F.col(uom) == CASE, F.coalesce(F.col(factor), F.col(fallback))
    )
    by_master = (F.col(uom) == CASE) & F.col(factor).isNull()
    return {
        "conversion_status": F.when(per_unit.isNotNull(), F.lit(CONVERTED)).otherwise(F.lit(UNKNOWN)),
        "conversion_source": F.when(per_unit.isNull(), F.lit(UNKNOWN))
        .when(by_master, F.lit(FROM_MASTER))
        .otherwise(F.lit(FROM_REFERENCE)),
        "eaches": F.col(qty) * per_unit,
    }


def unit_agreement(dim: DataFrame, ref: DataFrame, key: str, dim_pack: str, ref_pack: str) -> DataFrame:
    """One row: how many keys the reference covers and how often both pack sizes agree."""
    both = dim.select(key, F.col(dim_pack).alias("_d")).join(
        ref.select(key, F.col(ref_pack).alias("_r"), F.lit(True).alias("_seen")), key, "left"
    )
    covered = F.col("_seen").isNotNull()
    return both.agg(
        F.count("*").alias("product_skus"),
        F.count_if(covered).alias("with_uom_row"),
        F.count_if(~covered).alias("missing_uom_row"),
        F.count_if(F.col("_r") == F.col("_d")).alias("case_pack_matches_uom"),
        F.count_if(covered & ~F.col("_r").eqNullSafe(F.col("_d"))).alias("case_pack_differs_uom"),
    )


def clock_offset(df: DataFrame, group: str, ts: str, day: str, noise_floor: int = 2) -> DataFrame:
    """Estimated device-clock offset in hours per group.

    A group's typical hour is the median of (reading time − midnight of its partition day); the
    baseline is the median of the groups' medians. Offsets below `noise_floor` count as noise.
    Hours are counted per group before the median, so a group's size does not matter.
    """
    hours = df.select(group, hours_since(day, ts).alias("_h"))
    per_group = median_small_domain(hours, [group], "_h", "med_h")
    baseline = per_group.agg(F.median("med_h")).scalar()
    raw = round_to(F.col("med_h") - F.col("baseline_h"), 0).cast("int")
    return (
        per_group.withColumn("baseline_h", baseline)
        .withColumn("raw_offset_hours", raw)
        .withColumn(
            "observed_offset_hours",
            F.when(F.abs("raw_offset_hours") >= noise_floor, F.col("raw_offset_hours")).otherwise(F.lit(0)),
        )
    )
