"""The wide users table: appended whole, then replaced by selected fields."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.targets import Target
from tidemark.plans import jobs

# Every customer column five times over, by type: text, a time or a flag made from it.
TEXTS = ["id", *(f"text_{i}" for i in range(24))]
TIMESTAMPS = [f"time_{i}" for i in range(5)]
BOOLEANS = [f"flag_{i}" for i in range(7)]
SELECTED = ["id", *(f"text_{i}" for i in range(0, 24, 3)), "flag_0", "flag_3", "flag_5", "time_1", "time_4"]

WIDE = (
    [(name, T.VarcharType(256)) for name in TEXTS]
    + [(name, T.TimestampNTZType()) for name in TIMESTAMPS]
    + [(name, T.BooleanType()) for name in BOOLEANS]
)


def users(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    texts = [F.concat(F.lit(f"{name} "), "c_name").alias(name) for name in TEXTS if name != "id"]
    times = [(F.timestamp_seconds("c_custkey")).alias(name) for name in TIMESTAMPS]
    flags = [(F.col("c_custkey") % (i + 2) == 0).alias(name) for i, name in enumerate(BOOLEANS)]
    return customers.select(F.col("c_custkey").alias("id"), *flags, *times, *texts)


def test_users(spark, database, sf_dir):
    frame = users(spark, sf_dir)
    assert (len(WIDE), len(SELECTED)) == (37, 14)
    target = Target(spark, database, "users")
    target.append(frame, columns=WIDE)
    assert target.columns() == WIDE
    target.append(frame)
    assert target.read().count() == 2 * frame.count()

    kinds = {**dict(WIDE), "id": T.DecimalType(18, 0)}
    narrow = [(name, kinds[name]) for name in SELECTED]
    first, second = jobs.append_then_select(frame, frame, SELECTED, target, WIDE, narrow)
    assert first.n_rows == second.n_rows == frame.count()
    assert target.columns() == narrow
    row = target.read().where("id = 6").first()
    assert (row.text_0, row.flag_0, row.time_1.second) == ("text_0 Customer#000000006", True, 6)
    assert target.read().count() == frame.count()
