"""Access-log lines told from the ``events`` table.

The given tables hold no log lines. Each event becomes one line in the common
log format, with some sizes missing or unreadable, some lines malformed, blank or
padded and some times unreadable, so that every event takes part and every
parser branch is reached. Some hosts, endpoints and hours behave oddly enough
for the rules over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)

# A few hours keep few of their times; two offsets besides UTC occur.
_STAMP = """
CASE WHEN event_id % 101 = 0 THEN 'bad-time'
     WHEN ts >= timestamp_ntz'2024-01-12 04:00:00' AND ts < timestamp_ntz'2024-01-12 07:00:00'
       AND event_id % 100 <> 0 THEN 'bad-time'
     ELSE concat(date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'),
       CASE event_id % 13 WHEN 0 THEN ' -0400' WHEN 1 THEN ' +0530' ELSE ' +0000' END) END
"""

# Besides the users' hosts: one that reads everything, one that meets errors only, one
# that asks for one page, some that fetch one very large answer, and many seen a few times.
_HOST = """
CASE WHEN event_id % 29 = 4 THEN 'crawler'
     WHEN event_type = 'error' AND event_id % 31 = 5 THEN 'scanner'
     WHEN event_type <> 'error' AND event_id % 18 = 1 THEN 'poller'
     WHEN event_id % 2000 = 5 THEN concat('mirror', event_id)
     WHEN event_type <> 'error' AND event_id % 7 = 6
       THEN concat('host', user_id, '-', event_id % 11)
     ELSE concat('host', user_id) END
"""

# A page that everyone asks for, one that never fails, one that is mostly missing, and rare ones.
_REQUEST = """
concat(CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END, ' ',
       CASE WHEN event_id % 6 = 1 THEN '/index'
            WHEN event_type <> 'error' AND event_id % 11 = 2 THEN '/home'
            WHEN event_type = 'error' AND event_id % 13 = 8 THEN '/missing'
            WHEN event_id % 23 = 7
              THEN concat('/', event_type, '/', get_json_object(props, '$.k'), '/', event_id % 5)
            ELSE concat('/', event_type, '/', get_json_object(props, '$.k')) END,
       ' HTTP/1.0')
"""

_STATUS = """
CASE WHEN event_type = 'error' AND event_id % 3 <> 0 THEN 404
     WHEN event_type = 'error' THEN 500
     WHEN event_id % 17 = 0 THEN 304
     ELSE 200 END
"""

_SIZE = """
CASE WHEN event_id % 17 = 0 THEN '-'
     WHEN event_id % 89 = 1 THEN '12x'
     WHEN event_id % 89 = 2 THEN '3000000000'
     WHEN event_id % 2000 = 5 THEN '90000000'
     ELSE string(bigint(floor(value * 100))) END
"""


def _line(host: str) -> str:
    return f"""
    CASE WHEN event_id % 97 = 0 THEN concat('GARBAGE ', event_id)
         WHEN event_id % 107 = 1 THEN '   '
         ELSE concat({host}, ' - - [', {_STAMP}, '] "', {_REQUEST}, '" ', {_STATUS}, ' ', {_SIZE},
           CASE WHEN event_id % 103 = 1 THEN '  ' ELSE '' END)
    END
    """


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event."""
    return _events(spark, sf_dir).select(F.expr(_line(_HOST)).alias("log"))


def burst_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with bursts: some repeated, some of them by an unknown host."""
    beat = F.col("event_id") % 2500
    times = F.when(beat == 1, 60).when(beat == 2, 8).when(beat == 3, 40).otherwise(1)
    host = f"CASE WHEN event_id % 2500 = 3 THEN concat('ghost', event_id) ELSE {_HOST} END"
    return _events(spark, sf_dir).select(
        F.explode(F.array_repeat(F.expr(_line(host)), times)).alias("log")
    )
