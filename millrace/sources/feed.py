"""A raw event feed with dirty rows and repeated deliveries, derived from stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schema import RAW_COLUMNS

# Where re-delivered copies arrive, after the files 0..7 of the first deliveries.
FIRST_FILES = 8
LATE_FILE = 8


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten text columns per event plus `file_no`, the file it arrives in.

    Product attributes are looked up per event. The product table grows with the data, so no
    broadcast is forced: Spark broadcasts it while its size allows and otherwise joins by key,
    splitting hot products at run time. A re-delivered copy is a second element of the file
    list, so the events are read and joined once; copies name another source than the first
    delivery, which shows which of them a path keeps.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    products = spark.read.parquet(f"{sf_dir}/part.parquet")

    number = F.col("event_id")
    purchase = F.col("event_type") == "purchase"
    found = events.select(
        "*", F.get_json_object("props", "$.k").cast("int").alias("product_key")
    ).join(products, F.col("product_key") == F.col("p_partkey"), "left")

    event_id = F.when(number % 71 != 0, F.concat(F.lit("e"), number.cast("string")))
    price = F.when(number % 79 == 0, F.lit("abc")).otherwise(
        F.col("value").cast("decimal(10,2)").cast("string")
    )
    values = {
        "event_id": event_id,
        "event_time": F.when(number % 97 == 0, F.lit("not_a_timestamp")).otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        ),
        "user_id": F.when(number % 89 == 0, F.concat(F.lit("x"), F.col("user_id"))).otherwise(
            F.col("user_id").cast("string")
        ),
        "action": F.col("event_type"),
        "product_id": F.col("p_partkey").cast("string"),
        # Some names hold quotes, doubled quotes, commas and a comma within quotes.
        "product_name": F.when(
            number % 13 == 0, F.concat(F.col("p_name"), F.lit(' 27", "black", size ""L""'))
        ).otherwise(F.col("p_name")),
        "category": F.col("p_type"),
        "price": F.when(purchase & (number % 83 != 0), price),
        "quantity": F.when(purchase, (number % 5 + 1).cast("string")),
        "source": F.when(number % 2 == 0, "web").otherwise("mobile"),
    }
    first = (number % FIRST_FILES).cast("int")
    files = F.when(event_id.endswith("7"), F.array(first, F.lit(LATE_FILE))).otherwise(
        F.array(first)
    )
    rows = found.select(
        *(values[name].alias(name) for name in RAW_COLUMNS), F.explode(files).alias("file_no")
    )
    late = F.when(F.col("file_no") == LATE_FILE, "app").otherwise(F.col("source"))
    return rows.withColumn("source", late)
