"""The driver's tables in the shape of the clinic feeds.

``lineitem`` with its ``orders`` becomes the visit feed, ``customer`` the feed of a second
source, ``events`` the records of an extract. Text stays text here: dates, times and flags
arrive as the source would send them, with its gaps and errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE = "clinic"
SECOND_SOURCE = "crm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(number: Column, n: int, rest: int = 0) -> Column:
    return number % n == rest


def _letters(number: Column) -> Column:
    """A number spelled with the letters a to j."""
    return F.translate(number.cast("string"), "0123456789", "abcdefghij")


def _clock(minute_of_day: Column) -> Column:
    hours = F.lpad(F.floor(minute_of_day / 60).cast("string"), 2, "0")
    minutes = F.lpad((minute_of_day % 60).cast("string"), 2, "0")
    return F.concat(hours, F.lit(":"), minutes)


def _person(number: Column, turn: Column) -> dict[str, Column]:
    """Identifiers of one customer as typed in on one occasion.

    Three neighbouring numbers are one person, written in different ways and now and then
    with a gap or an error.
    """
    person = number - number % 3
    digits = F.lpad(person.cast("string"), 6, "0")
    mobile = F.concat(F.lit("0412"), digits)
    phone = (
        F.when(_every(number, 17), "12345")
        .when(_every(turn, 5, 0), F.concat(F.lit("0412 "), F.substring(digits, 1, 3), F.lit(" "), F.substring(digits, 4, 3)))
        .when(_every(turn, 5, 1), F.concat(F.lit("+61 412 "), digits))
        .when(_every(turn, 5, 2), F.concat(F.lit("0061412"), digits))
        .when(_every(turn, 5, 3), F.concat(F.lit("(04) 12-"), digits))
        .otherwise(F.substring(mobile, 2, 9))
    )
    email = F.when(
        ~_every(number, 3, 2),
        F.when(_every(turn, 2), F.concat(F.lit("  User"), digits, F.lit("@Example.COM ")))
        .otherwise(F.concat(F.lit("user"), digits, F.lit("@example.com"))),
    ).otherwise(F.when(_every(number, 2), "not an address"))
    first = F.when(~_every(number, 13), F.concat(F.lit("Ann-"), _letters(person)))
    birth = F.date_add(F.lit("1940-01-01").cast("date"), ((person * 37) % 25000 + F.when(_every(number, 11), 1).otherwise(0)).cast("int"))
    return {
        "patient_first_name": first,
        "patient_last_name": F.lit("O'Neil"),
        "patient_email": email,
        "patient_phone": phone,
        "patient_dob": F.when(~_every(number, 7), birth.cast("string")),
        "postcode": F.concat(F.lit("2"), F.lpad((person % 300).cast("string"), 3, "0")),
    }


def visit_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per ``lineitem`` row, as bronze holds it.

    The record id repeats (order and line number are not unique together), so later
    versions replace earlier ones. Both tables grow with the data, so they are joined by
    shuffle at every size; adaptive execution splits an order that has too many lines.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    part, order_no, line_no = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    start_minute = 480 + 15 * (part % 40)
    length = F.col("l_quantity").cast("int")
    end_minute = F.when(length == 47, start_minute - 30).otherwise(start_minute + length)
    day = F.col("l_shipdate").cast("date").cast("string")
    modified = F.col("l_shipdate") + F.make_dt_interval(mins=(part % 2880).cast("int"))
    flag = lambda on: F.when(on, "1").otherwise("0")
    return line.join(orders.hint("merge"), "l_orderkey").select(
        (order_no * 10 + line_no).alias("ID"),
        F.when(~_every(part, 997), F.col("o_custkey")).alias("patientID"),
        F.col("l_suppkey").alias("practitionerID"),
        F.when(~_every(part, 499), 1 + (F.col("l_suppkey") + line_no) % 25).alias("locationID"),
        F.when(_every(part, 211, 5), None)
        .when(_every(part, 211, 6), "31/02/2000")
        .when(_every(part, 211, 7), "")
        .when(_every(part, 211, 8), "  ")
        .when(_every(part, 211, 9), "\t")
        .when(_every(part, 211, 10), F.concat(F.lit("\n"), day, F.lit("\t")))
        .otherwise(day)
        .alias("appointmentDate"),
        F.when(_every(part, 223), "25:99")
        .when(_every(part, 223, 1), "")
        .when(_every(part, 223, 2), " ")
        .when(_every(part, 223, 3), "\t")
        .when(_every(part, 223, 4), "\r\n")
        .when(_every(part, 223, 5), F.concat(_clock(start_minute), F.lit("\r\n")))
        .otherwise(_clock(start_minute))
        .alias("appointmentStartTime"),
        F.when(length < 48, _clock(end_minute)).alias("appointmentEndTime"),
        F.element_at(
            F.array(F.lit("Initial"), F.lit("Standard"), F.lit("Extended")), (part % 3 + 1).cast("int")
        ).alias("appointmentType"),
        (1 + part % 6).alias("appointmentTypeID"),
        flag(line_no <= 6).alias("arrived"),
        flag(_every(part, 2)).alias("invoiceGenerated"),
        flag(_every(order_no, 11)).alias("DNA"),
        flag(_every(part, 9)).alias("cancelled"),
        F.when(_every(part, 9), day).alias("cancellationDate"),
        F.when(_every(part, 4), "patient called, sick").alias("Notes"),
        *[c.alias(n) for n, c in _person(F.col("o_custkey"), line_no).items()],
        modified.cast("string").alias("lastModified"),
        F.col("o_orderdate").cast("string").alias("dateCreated"),
        F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("_ingest_ts"),
        F.concat(F.lit("batch-"), (order_no % 8).cast("string")).alias("_batch_id"),
        F.sha2(
            F.concat_ws(
                "|", order_no, line_no, part, "l_suppkey", length, day
            ),
            256,
        ).alias("_payload_hash"),
    )


def patient_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patient feed of a second source, from ``customer``: every fourth patient is delivered
    twice, first with an older version that was written differently."""
    number, version = F.col("c_custkey"), F.col("version")
    versions = F.when(_every(number, 4), F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    modified = F.date_add(F.lit("2000-01-01").cast("date"), (number % 300 + version).cast("int"))
    return table(spark, sf_dir, "customer").withColumn("version", F.explode(versions)).select(
        number.alias("ID"),
        *[c.alias(n) for n, c in _person(number, number + version - 1).items()],
        modified.cast("timestamp").cast("string").alias("DateModified"),
        F.lit("2001-09-01").cast("timestamp").alias("_ingest_ts"),
        F.sha2(F.concat_ws("|", number, version), 256).alias("_payload_hash"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the records of an extract, one entity per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ID"),
        F.col("event_type").alias("entity"),
        F.col("user_id").alias("userID"),
        "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("lastModified"),
    )
