"""A2: local seed rows -> DataFrame with a declared schema.

These are the fixed values of the reference model (account list and pack
families).  They are small code tables; queries over the shared tables use
them only through joins or generators, never as their sole input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Pack variants (name, price multiplier) per pack family.
PACK_VARIANTS = {
    "Snacks": [("Single", 1.0), ("4-Pack", 3.6), ("Family Size", 2.2), ("Club Pack", 6.5)],
    "Beverages": [("12oz", 1.0), ("32oz Carton", 2.4), ("6-Pack", 5.2), ("12-Pack Club", 9.6)],
    "Personal Care": [("Travel 3oz", 0.6), ("Standard 12oz", 1.0), ("Family 20oz", 1.5),
                      ("Twin Pack", 1.85)],
}

# Our model: product category (p_type) -> pack family; unlisted categories
# take DEFAULT_PACK_FAMILY through a lookup with default.
CATEGORY_PACK_FAMILY = {"SMALL": "Personal Care", "MEDIUM": "Snacks", "LARGE": "Beverages"}
DEFAULT_PACK_FAMILY = "Snacks"

PACK_SCHEMA = T.StructType([
    T.StructField("pack_family", T.StringType(), False),
    T.StructField("variant_no", T.IntegerType(), False),
    T.StructField("variant", T.StringType(), False),
    T.StructField("multiplier", T.DecimalType(6, 2), False),
])


def pack_variants(spark: SparkSession) -> DataFrame:
    from decimal import Decimal
    rows = [(fam, i, name, Decimal(str(m)))
            for fam, lst in PACK_VARIANTS.items() for i, (name, m) in enumerate(lst, start=1)]
    return spark.createDataFrame(rows, PACK_SCHEMA)


def category_families(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(CATEGORY_PACK_FAMILY.items()),
                                 "category string, pack_family string")


def pack_values_sql() -> str:
    """The pack table as a SQL VALUES list (oracle side)."""
    rows = ", ".join(f"('{fam}', {i}, '{name}', CAST({m} AS DECIMAL(6,2)))"
                     for fam, lst in PACK_VARIANTS.items()
                     for i, (name, m) in enumerate(lst, start=1))
    return f"(VALUES {rows}) AS pk(pack_family, variant_no, variant, multiplier)"


def family_values_sql() -> str:
    rows = ", ".join(f"('{c}', '{f}')" for c, f in sorted(CATEGORY_PACK_FAMILY.items()))
    return f"(VALUES {rows}) AS cf(category, pack_family)"
