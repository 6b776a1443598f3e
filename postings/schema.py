"""The fixed record schema, so that no read has to infer one."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField(
            "description",
            T.StructType(
                [
                    T.StructField("text", T.StringType()),
                    T.StructField("conditions", T.StringType()),
                ]
            ),
        ),
        T.StructField("occupation", T.StructType([T.StructField("label", T.StringType())])),
        T.StructField(
            "must_have",
            T.StructType(
                [
                    T.StructField(
                        "skills",
                        T.ArrayType(T.StructType([T.StructField("label", T.StringType())])),
                    )
                ]
            ),
        ),
        T.StructField(
            "workplace_address",
            T.StructType(
                [
                    T.StructField("municipality", T.StringType()),
                    T.StructField("region", T.StringType()),
                ]
            ),
        ),
        T.StructField("number_of_vacancies", T.IntegerType()),
        T.StructField("publication_date", T.StringType()),
    ]
)

MUNICIPALITY = "workplace_address.municipality"
REGION = "workplace_address.region"
TITLE_LABEL = "occupation.label"


def ad_columns(**given: Column) -> list[Column]:
    """All columns of the schema in order: the given expressions, null for the rest.

    Nested fields are given under their leaf name (``municipality=...``).
    """
    leaves = {
        "description": ("text", "conditions"),
        "occupation": ("label",),
        "must_have": ("skills",),
        "workplace_address": ("municipality", "region"),
    }
    columns = []
    for field in AD_SCHEMA.fields:
        if field.name in leaves:
            parts = [
                given.get(leaf, F.lit(None)).cast(field.dataType[leaf].dataType).alias(leaf)
                for leaf in leaves[field.name]
            ]
            columns.append(F.struct(*parts).alias(field.name))
        else:
            columns.append(given.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name))
    return columns
