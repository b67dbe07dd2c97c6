"""The given tables in the shape of the feed, once for Spark and once as SQL text for the oracle.

Both forms follow the same formulas row by row over the whole ``events`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
RUN_ID = "run-1"
URL_PREFIX = "http://feed.example.org/exports/"

COUNTRY_CODE_CYCLE = [" us ", "usa", "N/A", "", "GB", "Z1", "FRA", "unknown", "CH", "NA", "ZZZ", "ni"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str, arrange=lambda events: events) -> DataFrame:
    """Events with their customer, nation and region."""
    e, c = arrange(table(spark, sf_dir, "events")), table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        e.join(c, e.user_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        .withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("int"))
    )


BASE_SQL = """
base AS (
  SELECT e.*, c.c_mktsegment, c.c_name, n.n_name, r.r_name,
         CAST(regexp_extract(e.props, '[0-9]+', 0) AS INTEGER) AS k
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def normalized_like(spark: SparkSession, sf_dir: str, country: str = "n_name") -> DataFrame:
    """Clean events in the shape of the query table."""
    return base(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("event_time_utc"),
        F.col("event_type").alias("primary_category"),
        F.col("c_mktsegment").alias("actor1_name"),
        F.col("n_name").alias("actor2_name"),
        F.col(country).alias("country_name"),
        F.concat(F.lpad(F.col("k").cast("string"), 2, "0"), F.lit("0")).alias("event_code"),
        (F.lit(10) - F.col("value").cast("decimal(10,2)") / 10).cast("decimal(8,3)").alias("goldstein_score"),
    )


def normalized_sql(country: str = "n_name") -> str:
    return f"""{BASE_SQL},
ne AS (
  SELECT event_id, ts AS event_time_utc, event_type AS primary_category, c_mktsegment AS actor1_name,
         n_name AS actor2_name, {country} AS country_name,
         lpad(CAST(k AS VARCHAR), 2, '0') || '0' AS event_code,
         CAST(10 - CAST(value AS DECIMAL(10,2)) / 10 AS DECIMAL(8,3)) AS goldstein_score
  FROM base
)"""


_RAW_FIELDS = {
    "GLOBALEVENTID": "CASE WHEN m % 11 = 0 THEN '' WHEN m % 11 = 1 THEN '000' || m "
                     "WHEN m % 11 = 3 THEN CAST(m - 1 AS {text}) ELSE CAST(m AS {text}) END",
    "SQLDATE": "CASE WHEN m % 17 = 0 THEN 'bad' ELSE {day} END",
    "DATEADDED": "CASE WHEN m % 997 = 5 THEN '20991231000000' WHEN m % 13 = 0 THEN '' "
                 "WHEN m % 13 = 1 THEN 'not-a-timestamp' ELSE {second} END",
    "Actor1Name": "CASE m % 8 WHEN 0 THEN '  ' WHEN 1 THEN 'unknown' WHEN 2 THEN ' Police ' WHEN 3 THEN 'HACKER GROUP' "
                  "WHEN 4 THEN 'Refugee Council' WHEN 5 THEN '-' ELSE c_name END",
    "Actor2Name": "CASE m % 6 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'PROTESTERS' ELSE n_name END",
    "EventCode": "CASE m % 19 WHEN 0 THEN '' WHEN 1 THEN 'ABC' WHEN 2 THEN '1712' WHEN 3 THEN '176' WHEN 4 THEN '064' "
                 "WHEN 5 THEN '023' ELSE lpad(CAST(k AS {text}), 2, '0') || '0' END",
    "GoldsteinScale": "CAST(k % 21 - 10 AS {text}) || '.5'",
    "ActionGeo_FullName": "CASE m % 23 WHEN 0 THEN 'Coastal flood zone' WHEN 1 THEN 'Cholera ward' "
                          "ELSE n_name || ', ' || r_name END",
    "ActionGeo_CountryCode": "CASE m % 12 "
                             + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(COUNTRY_CODE_CYCLE)) + " END",
    "ActionGeo_Lat": "CASE m % 10 WHEN 0 THEN '' WHEN 1 THEN '91.5' WHEN 2 THEN 'x' "
                     "ELSE CAST(k - 50 AS {text}) || '.1234567' END",
    "ActionGeo_Long": "CASE m % 14 WHEN 0 THEN '' WHEN 1 THEN '-181' ELSE CAST(3 * k - 150 AS {text}) || '.5' END",
    "AvgTone": "CASE m % 9 WHEN 0 THEN '' WHEN 1 THEN '25.5' WHEN 2 THEN '-31' WHEN 3 THEN 'bad' "
               "ELSE CAST(k % 41 - 20 AS {text}) || '.25' END",
    "SOURCEURL": "CASE m % 29 WHEN 0 THEN 'https://example.com/ransomware-attack' "
                 "WHEN 1 THEN 'https://example.com/notes/cyber-attack' ELSE 'https://example.com/' || m END",
}
_SPARK_DIALECT = {"text": "STRING", "day": "date_format(ts, 'yyyyMMdd')", "second": "date_format(ts, 'yyyyMMddHHmmss')"}
_DUCKDB_DIALECT = {"text": "VARCHAR", "day": "strftime(ts, '%Y%m%d')", "second": "strftime(ts, '%Y%m%d%H%M%S')"}


#: Rows of one task: a scan's splits say little, since one row group may hold a whole table.
TASK_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, and over more tasks as there are more rows, so that no task grows with the input. The count comes
    from the files' footers. The columns come out of a one-element ``inline``, so that a later filter, with all that it
    computes, is not moved below the exchange into the one task that reads a row group."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    spread_out = df.repartition(max(cores, -(-df.count() // TASK_ROWS)), "event_id")
    return spread_out.select(F.inline(F.array(F.struct(*df.columns))))


def raw_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty parsed rows: 13 texts, one export per day, file order by event id."""
    rows = base(spark, sf_dir, spread).withColumn("m", F.col("event_id"))
    day = F.date_format(F.col("ts"), "yyyyMMdd")
    return rows.select(
        "event_id",
        F.date_trunc("day", "ts").alias("export_time_utc"),
        F.concat(F.lit(URL_PREFIX), day, F.lit("000000.export.CSV.zip")).alias("export_url"),
        F.lit(RUN_ID).alias("ingestion_run_id"),
        F.col("event_id").alias("row_number"),
        *[F.expr(text.format(**_SPARK_DIALECT)).alias(name) for name, text in _RAW_FIELDS.items()],
    )


RAW_SQL = f"""{BASE_SQL},
raw AS (
  SELECT event_id, date_trunc('day', ts) AS export_time_utc,
         '{URL_PREFIX}' || strftime(ts, '%Y%m%d') || '000000.export.CSV.zip' AS export_url,
         '{RUN_ID}' AS ingestion_run_id, event_id AS row_number,
         {", ".join(f'{text.format(**_DUCKDB_DIALECT)} AS "{name}"' for name, text in _RAW_FIELDS.items())}
  FROM (SELECT *, event_id AS m FROM base)
)"""


# ---------------------------------------------------------------- ledgers derived from the events

_STATUS = "CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'failed' WHEN 2 THEN 'processing' ELSE 'completed' END"


def checkpoint_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger with many rows per hour-sized export, as left by writers without key checks."""
    e = spread(table(spark, sf_dir, "events"))
    hour = F.date_trunc("hour", "ts")
    return e.select(
        F.col("event_id").alias("id"),
        F.lit("feed").alias("source"),
        hour.alias("export_time_utc"),
        F.concat(F.lit(URL_PREFIX), F.date_format("ts", "yyyyMMddHH"), F.lit("0000.export.CSV.zip")).alias("export_url"),
        F.concat(F.date_format("ts", "yyyyMMddHH"), F.lit("0000.export.CSV.zip")).alias("export_filename"),
        F.expr(_STATUS).alias("status"),
        F.date_trunc("minute", "ts").alias("discovered_at"),
        F.when(F.col("event_id") % 5 == 2, F.col("ts").cast("timestamp")).alias("processing_started_at"),
        F.when((F.col("event_id") % 5 >= 3) & (F.col("event_id") % 7 > 0), F.date_trunc("hour", "ts")).alias("completed_at"),
        (F.col("event_id") % 3).cast("int").alias("attempt_count"),
        F.when(F.col("event_id") % 5 == 1, F.concat(F.lit("error "), (F.col("event_id") % 4).cast("string"))).alias("last_error"),
        F.lit(None).cast("bigint").alias("row_count_raw"),
        F.lit(None).cast("bigint").alias("row_count_inserted"),
        F.lit(None).cast("bigint").alias("row_count_duplicates"),
    )


CHECKPOINTS_SQL = f"""
cp AS (
  SELECT event_id AS id, 'feed' AS source, date_trunc('hour', ts) AS export_time_utc,
         '{URL_PREFIX}' || strftime(ts, '%Y%m%d%H') || '0000.export.CSV.zip' AS export_url,
         strftime(ts, '%Y%m%d%H') || '0000.export.CSV.zip' AS export_filename,
         {_STATUS} AS status, date_trunc('minute', ts) AS discovered_at,
         CASE WHEN event_id % 5 = 2 THEN ts END AS processing_started_at,
         CASE WHEN event_id % 5 >= 3 AND event_id % 7 > 0 THEN date_trunc('hour', ts) END AS completed_at,
         CAST(event_id % 3 AS INTEGER) AS attempt_count,
         CASE WHEN event_id % 5 = 1 THEN 'error ' || (event_id % 4) END AS last_error
  FROM events
)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log rows: one run per user, its events in order of id are the opening row and the patches."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("id"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.when(F.col("event_id") % 4 == 0, F.col("ts").cast("timestamp")).alias("finished_at"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'started' WHEN 1 THEN 'completed' ELSE 'failed' END").alias("status"),
        F.lit("manual").alias("trigger_mode"),
        F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 10).cast("int")).alias("exports_seen"),
        F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 9).cast("int")).alias("exports_completed"),
        F.when(F.col("event_id") % 5 == 0, F.col("event_id") * 2).alias("events_inserted"),
        F.when(F.col("event_id") % 7 == 0, F.col("event_id")).alias("events_duplicated"),
        F.when(F.col("event_id") % 3 == 2, F.lit("broken")).alias("error_summary"),
        F.col("event_id").alias("version"),
    )


RUNS_SQL = """
rl AS (
  SELECT 'run-' || user_id AS id, ts AS started_at, CASE WHEN event_id % 4 = 0 THEN ts END AS finished_at,
         CASE event_id % 3 WHEN 0 THEN 'started' WHEN 1 THEN 'completed' ELSE 'failed' END AS status,
         'manual' AS trigger_mode,
         CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 10 AS INTEGER) END AS exports_seen,
         CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 9 AS INTEGER) END AS exports_completed,
         CASE WHEN event_id % 5 = 0 THEN event_id * 2 END AS events_inserted,
         CASE WHEN event_id % 7 = 0 THEN event_id END AS events_duplicated,
         CASE WHEN event_id % 3 = 2 THEN 'broken' END AS error_summary,
         event_id AS version
  FROM events
)"""
