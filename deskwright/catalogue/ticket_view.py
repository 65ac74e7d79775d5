"""A ticket export derived from the ``orders`` table, with every kind of defect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskwright import fixed
from deskwright.rules import QualityRules
from deskwright.sources.numbering import spread
from deskwright.sources.readers import envelope_of

# One SELECT that Spark and other SQL engines read alike.
TICKET_VIEW = """
SELECT o_orderkey + 1 AS row_number,
  'SD-' || CAST(CASE WHEN o_orderkey % 101 = 5 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) AS ticket_id,
  CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN '  Padded   title  ' ELSE 'Order issue ' || CAST(o_orderkey % 500 AS STRING) END AS title,
  'Order ' || CAST(o_orderkey AS STRING) || '; write User' || CAST(o_custkey AS STRING) || '@Example.invalid or call +1-202-555-' || lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') AS description,
  CASE WHEN o_orderkey % 83 = 0 THEN 'Mystery' ELSE ' ' || o_orderstatus END AS status,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 61 = 0 THEN '' ELSE 'Customer' || CAST(o_custkey AS STRING) || '@Example.invalid' END AS requester_email,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'engineer-' || CAST(o_custkey % 100 AS STRING) END AS assignee,
  CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T00:00:00Z' AS created_at,
  CASE WHEN o_orderkey % 79 = 0 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT) AS STRING) || 'T06:00:00+02:00' END AS updated_at,
  CASE WHEN o_orderkey % 73 = 0 THEN CAST(CAST(o_orderdate AS DATE) - 1 AS STRING) || 'T00:00:00Z'
       WHEN (o_orderstatus = 'F') <> (o_orderkey % 11 = 0) THEN CAST(CAST(o_orderdate AS DATE) + 9 AS STRING) || 'T00:00:00Z' ELSE '' END AS resolved_at,
  CASE WHEN o_orderkey % 59 = 0 THEN '' WHEN o_orderkey % 101 IN (4, 5) THEN 'desk-0' ELSE 'desk-' || CAST(o_custkey % 4 AS STRING) END AS source_system
FROM {orders}
"""

VIEW_RULES = QualityRules.from_dict(
    {
        "source_system": "desk-default",
        "reference_time": "2001-08-31T00:00:00Z",
        "timeliness_days": 1_000,
        "quality_threshold": 0.85,
        "required_fields": fixed.USUAL_REQUIRED_FIELDS,
        "status_mapping": {"o": "Open", "p": "Pending", "f": "Resolved"},
        "priority_mapping": {
            "1-urgent": "Critical",
            "2-high": "High",
            "3-medium": "Medium",
            "4-not specified": "Low",
            "5-low": "Low",
        },
        "allowed_statuses": fixed.STATUSES,
        "allowed_priorities": fixed.PRIORITIES,
    }
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


def view_of(orders: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(TICKET_VIEW, orders=orders)


def ticket_view(spark: SparkSession, folder: str) -> DataFrame:
    return view_of(spread(table(spark, folder, "orders"), row_groups=True, bounded=True))


def ticket_envelope(spark: SparkSession, folder: str) -> DataFrame:
    return envelope_of(ticket_view(spark, folder))
