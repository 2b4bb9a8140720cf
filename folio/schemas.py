"""Schemas of the tables that enter and leave the pipeline."""

from pyspark.sql import types as T

ARTICLES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("subtitle", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

_BASIC = T.StructType([T.StructField("basic", T.StringType())])
_ITEM = T.StructType([T.StructField("content", T.StringType()), T.StructField("text", T.StringType())])
_ELEMENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("items", T.ArrayType(_ITEM)),
    ]
)

CMS_ARTICLE = T.StructType(
    [
        T.StructField("headlines", _BASIC),
        T.StructField("subheadlines", _BASIC),
        T.StructField("description", _BASIC),
        T.StructField("content_elements", T.ArrayType(_ELEMENT)),
        T.StructField("display_date", T.StringType()),
        T.StructField("first_publish_date", T.StringType()),
        T.StructField("website_url", T.StringType()),
        T.StructField(
            "credits",
            T.StructType(
                [
                    T.StructField(
                        "by", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
                    )
                ]
            ),
        ),
    ]
)

CMS_PAGE = T.StructType(
    [
        T.StructField("count", T.LongType()),
        T.StructField("content_elements", T.ArrayType(CMS_ARTICLE)),
    ]
)

CV_RESULTS = T.StructType(
    [T.StructField("model", T.StringType())]
    + [
        T.StructField(f"{metric}_{stat}", T.DoubleType())
        for metric in ("accuracy", "macro_f1", "weighted_f1")
        for stat in ("mean", "std")
    ]
    + [T.StructField("train_time_s", T.DoubleType())]
)
