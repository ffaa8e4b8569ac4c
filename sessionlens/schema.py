"""Session table schema and column roles."""

from pyspark.sql import types as T

# Fixed values that must equal the reference's for equal results:
# column roles and names of the session table.
TARGET = "is_click"
DATETIME = "DateTime"
INDEX_COLUMNS = ["session_id", "user_id"]
COLUMNS_TO_DROP = ["product_category_2", "city_development_index"]
TEST_PRODUCT = "A"
SPLIT_RATIOS = (0.6, 0.2, 0.2)
RANDOM_STATE = 42
RARE_GROUP_THRESHOLD = 20

# Order column carried from load to output; pandas row order means something
# in several operators, and Spark has no row order of its own.
ROW_ORD = "row_ord"

SESSION_SCHEMA = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("DateTime", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("campaign_id", T.LongType()),
    T.StructField("webpage_id", T.LongType()),
    T.StructField("product_category_1", T.LongType()),
    T.StructField("product_category_2", T.LongType()),
    T.StructField("user_group_id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age_level", T.LongType()),
    T.StructField("user_depth", T.LongType()),
    T.StructField("city_development_index", T.LongType()),
    T.StructField("var_1", T.LongType()),
    T.StructField("is_click", T.IntegerType()),
])

RAW_COLUMNS = [f.name for f in SESSION_SCHEMA.fields]
