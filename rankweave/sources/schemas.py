"""Schemas of the text inputs. Feature logs have no header, so the column order is part of the format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns of a feature log in file order.
FEATURE_LOG_COLUMNS = """
device_id string, feed_id string,
avg_kd_duration_1 double, avg_kd_duration_7 double,
short_interest_content_tag_doc string, short_interest_category_tag_doc string,
long_interest_content_tag_doc string, long_interest_category_tag_doc string,
feed_type int, feed_pic_num int,
content_tags_doc string, category_tags_doc string,
has_title boolean,
title_size int, pub_days int, read_count int, like_count int, comment_count int, share_count int,
ctr_7 double,
label int, label_date string, timestamp string, r_source string,
age int, sex int, recom_level int,
income string, consumption_level string, education_level string, occupation string,
frequent_vv_hour string, workday_vv_hour string, non_workday_vv_hour string,
app_interest_tag string, installed_app_name string,
frequent_city string, mobile_device_manu string, device_model string, favorite_celebrity string,
interest_preference string, favorite_circle string, browsed_circle string,
realtime_short_content_tags string, realtime_short_category_tags string, activeuser string
"""

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _schema(columns: str) -> T.StructType:
    """Pairs of a name and a type, without a session: Spark's own DDL parser needs a running one."""
    pairs = [column.split() for column in columns.replace("\n", " ").split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


FEATURE_LOG = _schema(FEATURE_LOG_COLUMNS)

#: The short form used by jobs that need ids and three features only.
SHORT_LOG = _schema("user_id string, feed_id string, feature1 double, feature2 int, feature3 boolean")

HISTORY = _schema("device_id string, feeds string")


def schema_json(df: DataFrame) -> str:
    return df.schema.json()
