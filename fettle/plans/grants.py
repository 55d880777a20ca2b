"""The grants view: a wide, dirty text table derived from the generated star schema.

Every column is one SQL expression that Spark and other engines read alike, so the same
text defines the table here and in the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.sources.positions import read_parquet_numbered, with_row_number

# The view definition, in column order after row_number.
COLUMNS = {
    "ref_number": "'R-' || CAST(o_orderkey - CASE WHEN o_orderkey % 20 = 1 THEN 1 ELSE 0 END AS string)",
    "amendment_number": "CASE WHEN o_orderkey % 20 = 1 THEN '1' ELSE '0' END",
    "amendment_date": "CASE WHEN o_orderkey % 20 = 1 AND o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS date) AS string) END",
    "agreement_type": "CASE WHEN o_orderkey % 1009 = 0 THEN NULL ELSE o_orderstatus END",
    "recipient_type": "CASE WHEN o_orderkey % 4 = 0 THEN substr(c_mktsegment, 1, 1) WHEN o_orderkey % 4 = 1 THEN '  ' END",
    "recipient_legal_name": """CASE WHEN o_orderkey % 97 = 0 THEN 'U.Q.A.M.'
        WHEN o_orderkey % 101 = 0 THEN 'COOP UQAM'
        WHEN o_orderkey % 103 = 0 THEN 'Université du Québec à Montréal'
        WHEN o_orderkey % 107 = 0 THEN 'AQAM'
        WHEN o_orderkey % 109 = 0 THEN 'UQAM|UQAM'
        WHEN o_orderkey % 6 = 1 THEN upper(p_name)
        WHEN o_orderkey % 6 = 2 THEN replace(p_name, ' ', '-')
        WHEN o_orderkey % 30 = 3 THEN p_name || ' / ' || p_name
        WHEN o_orderkey % 30 = 9 THEN p_name || '|' || upper(p_name) || '|' || p_name
        WHEN o_orderkey % 6 = 4 THEN replace(p_name, 'e', 'é')
        WHEN o_orderkey % 6 = 5 THEN ' ' || p_name
        ELSE p_name END""",
    "recipient_operating_name": "CASE WHEN o_orderkey % 20 = 0 THEN p_brand END",
    "recipient_country": "CASE WHEN o_orderkey % 501 = 0 THEN NULL WHEN n_nationkey < 20 THEN 'CA' ELSE 'N' || CAST(n_nationkey AS string) END",
    "recipient_province": "CASE WHEN n_nationkey >= 20 THEN NULL WHEN o_orderkey % 50 = 0 THEN '' ELSE 'P' || CAST(n_regionkey AS string) END",
    "recipient_city": "n_name",
    "recipient_postal_code": "CASE WHEN o_orderkey % 3 = 0 THEN 'NA' WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE 'K' || CAST(o_custkey % 10 AS string) END",
    "agreement_value": "CAST(CAST(round(o_totalprice / 50000) AS bigint) * 50000 AS string)",
    "agreement_start_date": "CAST(CAST(date_trunc('month', o_orderdate) AS date) AS string)",
    "agreement_end_date": "CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(CAST(o_orderdate AS date) + INTERVAL 365 DAY AS date) AS string) END",
    "foreign_currency_type": "CASE WHEN o_orderkey % 13 = 0 THEN 'USD' END",
    "foreign_currency_value": "CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey AS string) END",
    "coverage": "CASE WHEN o_orderkey = 7 THEN 'x' END",
}

_PART_NAMES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Names come from part keys 0 to 63: the primary key bounds the broadcast to 64 rows.
    part = table(spark, sf_dir, "part").where(F.col("p_partkey").between(0, _PART_NAMES - 1))
    return (
        read_parquet_numbered(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(F.broadcast(part), F.expr(f"p_partkey = o_orderkey % {_PART_NAMES}"))
    )


def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with ``row_number``, the place of the order in its table.

    The scan gives the place, without a shuffle; each order has one customer, nation and
    part, so every place is there once.
    """
    cells = [f"{sql} AS {name}" for name, sql in COLUMNS.items()]
    return _joined(spark, sf_dir).selectExpr("row_number", *cells)


def numbered_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same view numbered by the order of a key instead of the scan."""
    cells = [f"{sql} AS {name}" for name, sql in COLUMNS.items()]
    keyed = _joined(spark, sf_dir).drop("row_number").selectExpr("o_orderkey AS _key", *cells)
    return with_row_number(keyed, "_key").select("row_number", *COLUMNS)


def grants_sql() -> str:
    """The same view as one SQL statement."""
    cells = ",\n  ".join(f"{sql} AS {name}" for name, sql in COLUMNS.items())
    return f"""SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS bigint) AS row_number,
  {cells}
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON p_partkey = o_orderkey % {_PART_NAMES}"""
