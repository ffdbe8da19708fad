"""Card transactions derived from the given order tables.

Line items become transactions: order, customer and part attributes supply the
customer, channel, category, segment and scores, and fixed arithmetic on the
keys plants fraud effects and the dirty values the quality rules must catch. Some
rows have a copy under a new id, a copy without its time, or one without its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TX_SQL = """
WITH base AS (
  SELECT l_orderkey AS ok, l_partkey AS pk,
         l_orderkey * 10 + l_linenumber AS transaction_id,
         CASE WHEN l_orderkey % 1013 = 5 THEN NULL ELSE o_custkey END AS customer_id,
         CASE WHEN l_orderkey % 1019 = 7 THEN -l_extendedprice ELSE l_extendedprice END AS amount,
         CASE WHEN l_orderkey % 983 = 3 THEN 'pix'
              WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'compra'
              WHEN o_orderpriority = '2-HIGH' THEN 'saque'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'transferencia'
              ELSE 'pagamento' END AS transaction_type,
         CASE WHEN l_linenumber <= 3 THEN 'app' WHEN l_linenumber <= 5 THEN 'web'
              WHEN l_linenumber = 6 THEN 'pos' ELSE 'atm' END AS ch,
         CASE p_type WHEN 'STANDARD' THEN 'varejo' WHEN 'ECONOMY' THEN 'viagem'
              WHEN 'MEDIUM' THEN 'eletronico' WHEN 'SMALL' THEN 'alimentacao'
              WHEN 'LARGE' THEN 'servicos' ELSE 'saude' END AS cat,
         l_shipdate + make_dt_interval(0, CAST(l_partkey % 24 AS INT)) AS ts,
         CAST(l_partkey % 24 AS INT) AS hr,
         CASE WHEN l_orderkey % 1021 = 11 THEN 250.0D ELSE l_quantity * 2.0D END AS risk_score,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Premium'
              WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Standard'
              ELSE 'High-Risk' END AS seg,
         CASE WHEN l_orderkey % 1031 = 13 THEN 1000
              ELSE CAST(300 + FLOOR((c_acctbal + 1000) * 6 / 110) AS INT) END AS credit_score,
         (l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709
          + l_linenumber * 15485863) % 1000 AS h,
         l_returnflag AS rf, l_linestatus AS ls
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
       JOIN ({orders} JOIN {customer} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
),
labelled AS (
  SELECT *, h < (CASE seg WHEN 'Premium' THEN 8 WHEN 'Standard' THEN 24 ELSE 90 END)
              * (CASE WHEN ch = 'app' THEN 2 ELSE 1 END)
              * (CASE WHEN cat = 'viagem' THEN 2 ELSE 1 END)
              + (CASE WHEN hr < 5 THEN 20 ELSE 0 END) AS fr
  FROM base
),
rows AS (
  SELECT transaction_id, customer_id, amount, transaction_type,
         CASE WHEN ok % 997 = 2 THEN 'whatsapp'
              WHEN pk % 50 = 1 THEN CONCAT(' ', UPPER(ch), ' ') ELSE ch END AS channel,
         CASE WHEN ok % 991 = 4 THEN 'jogos'
              WHEN pk % 40 = 3 THEN UPPER(cat) ELSE cat END AS merchant_category,
         ts,
         CASE WHEN ok % 977 = 6 THEN 'pending'
              WHEN fr OR (rf = 'R' AND ls = 'F') THEN 'declined' ELSE 'approved' END AS status,
         risk_score,
         CASE WHEN ok % 971 = 8 THEN 'VIP' ELSE seg END AS segment,
         credit_score,
         CASE WHEN ok % 967 = 9 THEN 'talvez'
              WHEN pk % 30 = 0 THEN (CASE WHEN fr THEN '1' ELSE '0' END)
              ELSE (CASE WHEN fr THEN 'True' ELSE 'False' END) END AS is_fraud,
         CASE ok % 500
              WHEN 3 THEN array(named_struct('shift', 0L, 'dated', TRUE),
                                named_struct('shift', 1000000000L, 'dated', TRUE))
              WHEN 13 THEN array(named_struct('shift', 0L, 'dated', TRUE),
                                 named_struct('shift', 0L, 'dated', FALSE))
              WHEN 23 THEN array(named_struct('shift', 0L, 'dated', TRUE),
                                 named_struct('shift', CAST(NULL AS BIGINT), 'dated', TRUE))
              ELSE array(named_struct('shift', 0L, 'dated', TRUE)) END AS copies
  FROM labelled
)
SELECT transaction_id + copy.shift AS transaction_id, customer_id, amount, transaction_type, channel,
       merchant_category, IF(copy.dated, ts, NULL) AS timestamp, status, risk_score, segment, credit_score, is_fraud
FROM rows LATERAL VIEW explode(copies) c AS copy
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transaction rows, in the raw file's column layout.

    Customers are joined to orders before line items are, so that the longer table is
    not moved once more for them. The planted copies are exploded from the same row, so the four-table
    join runs once rather than once per branch of a union.
    """
    names = ("lineitem", "orders", "customer", "part")
    return spark.sql(RAW_TX_SQL, **{n: table(spark, sf_dir, n) for n in names})
