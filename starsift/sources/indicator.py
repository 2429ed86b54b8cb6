"""A wide economic-indicator table as (year, rate) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_indicator(
    spark: SparkSession,
    path: str,
    country: str = "USA",
    indicator: str | None = None,
) -> DataFrame:
    """Read the yearly rates of one country from a wide CSV.

    The header is the line whose second field reads ``Country Code``, however many
    lines stand before it. Of several rows of the country the first by indicator
    code counts, unless ``indicator`` names one. Lines may have any number of fields;
    the file is read once to see how many.
    """
    written = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    commas = F.length("value") - F.length(F.replace("value", F.lit(",")))
    width = (written.agg(F.max(commas)).first()[0] or 0) + 1
    schema = ", ".join(f"c{i} STRING" for i in range(width))
    row = F.from_csv("value", schema, {"mode": "PERMISSIVE", "maxColumns": str(width + 1)})
    fields = F.array(*[F.col(f"r.c{i}") for i in range(width)])
    lines = (
        written
        .select(row.alias("r"))
        .select(fields.alias("f"))
    )
    code = F.trim(F.get("f", F.lit(1)))
    kind = F.trim(F.get("f", F.lit(3)))
    # min() over a struct keeps one line of each kind and never gathers the file.
    header = lines.filter(code == "Country Code").agg(F.min("f").alias("names"))
    wanted = code == country
    if indicator is not None:
        wanted = wanted & (kind == indicator)
    values = lines.filter(wanted).agg(F.min_by("f", kind).alias("values"))
    names = header.select(F.posexplode("names").alias("pos", "name"))
    cells = values.select(F.posexplode("values").alias("pos", "value"))
    name = F.trim("name")
    return (
        names.filter(name.rlike("^[0-9]+$"))
        .join(F.broadcast(cells), "pos")
        .select(
            name.cast("int").alias("year"),
            F.trim("value").try_cast("double").alias("rate"),
        )
        .filter(F.col("rate").isNotNull())
    )
