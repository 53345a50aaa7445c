"""Drifting pages (S1): reviews kept as ``variant``, typed by path, and a report of what changed day by day.

The page contract reads the fields it knows and forgets the others. Here the raw review objects stay beside them, so a
field that appears or changes its type loses nothing: it is counted per day, can be typed later from the stored variant,
and a number that starts to arrive as a string is still read as a number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critica.schemas import REVIEW

# JSON types that hold a contract type
_FITS = {"string": ("STRING",), "bigint": ("BIGINT",), "boolean": ("BOOLEAN",), "double": ("DOUBLE", "DECIMAL", "BIGINT")}


def contract_fields() -> dict[str, str]:
    """Field -> type of a review object in the page contract; nested objects are ``object``."""
    return {f.name: f.dataType.simpleString() if not hasattr(f.dataType, "fields") else "object" for f in REVIEW.fields}


def raw_reviews(pages: DataFrame, page: str = "value", *keep: str) -> DataFrame:
    """(keep, review: variant, bad: string) of pages given as JSON text: one row per element of ``reviews``; a page that is
    no JSON object is one row with its text in ``bad``."""
    parsed = pages.withColumn("v__", F.try_parse_json(F.col(page)))
    reviews = F.try_variant_get("v__", "$.reviews", "array<variant>")
    good = parsed.where(F.col("v__").isNotNull()).select(*keep, F.explode(reviews).alias("review"), F.lit(None).cast("string").alias("bad"))
    bad = parsed.where(F.col("v__").isNull()).select(*keep, F.lit(None).cast("variant").alias("review"), F.col(page).alias("bad"))
    return good.unionByName(bad)


def field_types(reviews: DataFrame, *keep: str) -> DataFrame:
    """(keep, field, type, n): how often each field of the review objects came with each JSON type; nulls are VOID."""
    spark = reviews.sparkSession
    fields = spark.tvf.variant_explode(F.col("review").outer())
    each = reviews.where(F.col("review").isNotNull()).lateralJoin(fields)
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^[A-Za-z]+", 0)
    return each.groupBy(*keep, F.col("key").alias("field"), kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))


def drift_report(reviews: DataFrame, *keep: str, contract: Mapping[str, str] | None = None) -> DataFrame:
    """``field_types`` with ``status``: known, unknown (no field of the contract) or retyped (another type; null fits)."""
    contract = dict(contract or contract_fields())
    known = F.col("field").isin(*contract)
    fits = F.lit(False)
    for name, kind in contract.items():
        allowed = ("OBJECT", "VOID") if kind == "object" else (*_FITS.get(kind, (kind.upper(),)), "VOID")
        fits = fits | ((F.col("field") == name) & F.col("type").isin(*allowed))
    status = F.when(~known, "unknown").when(fits, "known").otherwise("retyped")
    return field_types(reviews, *keep).withColumn("status", status)


def typed(reviews: DataFrame, paths: Mapping[str, tuple[str, str]], *keep: str) -> DataFrame:
    """(keep, one column per entry of ``paths``: name -> (path, type)); a value that cannot be read as the type is null."""
    return reviews.select(*keep, *[F.try_variant_get("review", path, kind).alias(name) for name, (path, kind) in paths.items()])
