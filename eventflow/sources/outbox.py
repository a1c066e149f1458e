"""Publishing a durable outbox to the log, each event once.

The outbox is a table of events that services write together with their own data. A relay publishes what is not
marked as published, into a folder of the log named after the relay's number, and then marks it. The number is
one more than that of the last marks, so a relay that died behind its publishing and before its marks is done
again under the same number: it replaces the same folder, and the log never holds an event twice. Marks are
read back from what was published, so they can't tell of more than the log has.

That holds for file formats. A broker has no folders to replace: there an event may be published again, under
the same id, after such a death.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventflow.operators.audit import outbox_relay
from eventflow.operators.envelope import event_type, parse_envelope
from eventflow.schemas import LOG_RECORD
from eventflow.sources.logs import read_log, to_records

_MARKS = T.StructType([T.StructField("id", T.StringType()), T.StructField("relay", T.LongType())])


def marks(spark: SparkSession, location: str) -> DataFrame:
    """(id, relay): what has been published, and by which relay. A folder that is not there has no marks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _MARKS)
    return spark.read.schema(_MARKS).option("basePath", location).parquet(f"{location}/relay=*")


def relay(outbox: DataFrame, log: str, marked: str, format: str = "json") -> int:
    """Publish the rows of the outbox (id, event) that are not marked in the folder `marked`; the relay's number.

    `event` is an envelope whose id is the row's. Rows that were deleted from the outbox stay published; a row
    that is there twice is published once. A relay that finds nothing new leaves no marks, and its number is used again.
    """
    spark = outbox.sparkSession
    done = marks(spark, marked)
    number = (done.agg(F.max("relay")).first()[0] or 0) + 1
    pending = outbox_relay(outbox.select("id", "event").dropDuplicates(["id"]), done)
    to_records(pending).write.format(format).mode("overwrite").save(f"{log}/relay={number}")
    published = parse_envelope(event_type(read_log(spark, f"{log}/relay={number}", format)))
    ids = published.select("id")
    if not ids.isEmpty():
        ids.write.mode("overwrite").parquet(f"{marked}/relay={number}")
    return number


def read_published(spark: SparkSession, log: str, format: str = "json") -> DataFrame:
    """The records of all relays."""
    return spark.read.format(format).schema(LOG_RECORD).option("basePath", log).load(f"{log}/relay=*")
