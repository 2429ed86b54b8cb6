"""The review relation and indicator table as views over star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.operators.cleaning import clean_reviews
from starsift.operators.mismatch import mismatched
from starsift.sources.indicator import read_indicator
from starsift.sources.workspace import materialize, spread, table_path

COUNTRY = "NATION_0"
BLANK_YEAR = 1998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def epoch_millis(c: str) -> Column:
    """Milliseconds since 1970 of a timestamp without zone, in any session zone."""
    day = F.unix_date(F.to_date(c)).cast("long")
    minute = F.hour(c) * 60 + F.minute(c)
    milli = F.date_part(F.lit("SECOND"), F.col(c)) * 1000
    return day * 86_400_000 + minute * 60_000 + milli.cast("long")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order, its whole text a document.

    Some users always rate 5, some of them with low scores; some texts are null or
    blank; orders without lines have no product; some ratings, scores, users and
    times are null.
    """
    orders = spread(table(spark, sf_dir, "orders"))
    documents = table(spark, sf_dir, "documents")
    part = table(spark, sf_dir, "part")
    first_line = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("pk"))
    )
    count = documents.agg(F.count("*").alias("c")).scalar()
    key, user = F.col("o_orderkey"), F.col("o_custkey")
    joined = (
        orders.withColumn("_doc", key % count)
        .join(first_line, F.col("l_orderkey") == key, "left")
        .join(part.select("p_partkey", "p_brand", "p_type"), F.col("p_partkey") == F.col("pk"), "left")
        .join(documents.select("doc_id", "text"), F.col("doc_id") == F.col("_doc"), "left")
    )
    priority = F.substring("o_orderpriority", 1, 1).cast("double")
    return joined.select(
        key.alias("review_id"),
        F.when(key % 83 == 0, None).when(user % 50 == 0, 5.0).otherwise(priority).alias("rating"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, "   ").otherwise(F.col("text")).alias("text"),
        F.col("pk").cast("string").alias("asin"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.when(key % 73 != 0, user.cast("string")).alias("user_id"),
        F.when(key % 71 != 0, epoch_millis("o_orderdate") + (key * 7919) % 86_400_000)
        .alias("timestamp"),
        (F.col("o_orderstatus") != "P").alias("verified_purchase"),
        (key % 13).cast("int").alias("helpful_vote"),
        F.when(key % 79 == 0, None)
        .when(user % 100 == 0, 1 + key % 2)
        .otherwise(1 + (key * 31 + user) % 5)
        .cast("int")
        .alias("sentiment_star"),
        ((key * 7919) % 1000 / F.lit(1000.0)).cast("float").alias("sentiment_conf"),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned reviews with the scores of the view."""
    return clean_reviews(reviews(spark, sf_dir))


def conflicting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mismatched ones among the cleaned reviews."""
    return mismatched(clean(spark, sf_dir))


def write_indicator_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write mean discount per nation and order year as a wide CSV; its path.

    Two preamble lines, a header, one line per nation, one year left blank.
    """
    nation = table(spark, sf_dir, "nation")
    # Sums go up level by level, so that no busy order or customer is joined line by line.
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_discount").alias("s"), F.count("l_discount").alias("n"))
    )
    bought = (
        table(spark, sf_dir, "orders")
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    mean = F.try_divide(F.sum("s"), F.sum("n"))
    rates = (
        bought.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "year")
        .agg(F.round(mean * 100, 4).alias("rate"))
        .withColumn("rate", F.when(F.col("year") != BLANK_YEAR, F.col("rate")))
    )
    wide = materialize(rates, "rates").groupBy("n_name").pivot("year").agg(F.first("rate"))
    years = [c for c in wide.columns if c != "n_name"]

    def line(*fields):
        quoted = [F.concat(F.lit('"'), F.coalesce(f.cast("string"), F.lit("")), F.lit('"')) for f in fields]
        return F.concat(F.concat_ws(",", *quoted), F.lit(",")).alias("value")

    body = wide.select(
        line(
            F.concat(F.lit("Nation, "), "n_name"),
            F.col("n_name"),
            F.lit("Mean discount (annual %)"),
            F.lit("DISCOUNT"),
            *[F.col(y) for y in years],
        )
    )
    names = ["Country Name", "Country Code", "Indicator Name", "Indicator Code", *years]
    head = spark.range(1).select(
        F.explode(
            F.array(
                F.lit('"Data Source","Order lines",'),
                F.lit(""),
                line(*[F.lit(n) for n in names]),
            )
        ).alias("value")
    )
    path = table_path(spark, "indicator")
    head.union(body).coalesce(1).write.text(path)
    return path


def indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly rates of one nation, read back from the wide CSV."""
    return read_indicator(spark, write_indicator_csv(spark, sf_dir), COUNTRY)
