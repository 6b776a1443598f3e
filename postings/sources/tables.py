"""The test tables in the shape of the ad schema."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.schema import ad_columns


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_ads(
    spark: SparkSession,
    folder: str,
    title: bool = False,
    place: bool = False,
    vacancies: bool = False,
) -> DataFrame:
    """One ad per order. Fields that need a join are null unless asked for."""
    ads = table(spark, folder, "orders")
    given = {"id": F.col("o_orderkey"), "publication_date": F.col("o_orderdate").cast("date")}
    if title or vacancies:
        # (l_orderkey, l_linenumber) is not unique: one row per order first.
        lines = (
            table(spark, folder, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.min("l_partkey").alias("first_part"), F.sum("l_quantity").alias("quantity"))
        )
        ads = ads.join(lines, ads["o_orderkey"] == lines["l_orderkey"], "left")
        given["number_of_vacancies"] = F.when(F.col("o_orderstatus") != "P", F.col("quantity"))
    if title:
        part = table(spark, folder, "part")
        ads = ads.join(part, ads["first_part"] == part["p_partkey"], "left")
        given["label"] = F.concat("p_name", F.lit(", "), "p_brand")
    if place:
        nation = table(spark, folder, "nation")
        region = table(spark, folder, "region")
        customer = (
            table(spark, folder, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
        ads = ads.join(customer, ads["o_custkey"] == customer["c_custkey"], "left")
        known = F.col("c_mktsegment") != "MACHINERY"
        given["municipality"] = F.when(known, F.col("n_name"))
        given["region"] = F.when(known, F.col("r_name"))
    return ads.select(*ad_columns(**given))


def line_ads(spark: SparkSession, folder: str) -> DataFrame:
    """One ad per order line asking for one skill, so that no order's lines are gathered."""
    lines = table(spark, folder, "lineitem")
    part = table(spark, folder, "part")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"]).select(
        *ad_columns(
            id=F.col("l_orderkey"),
            skills=F.array(F.struct(F.col("p_type").alias("label"))),
        )
    )


def document_ads(spark: SparkSession, folder: str) -> DataFrame:
    """One ad per document: its source is the municipality, its language the region."""
    documents = table(spark, folder, "documents")
    return documents.select(
        *ad_columns(
            id=F.col("doc_id"),
            headline=F.substring_index("text", "\n", 1),
            text=F.col("text"),
            label=F.concat("lang", F.lit(", "), "source"),
            municipality=F.col("source"),
            region=F.col("lang"),
        )
    )
