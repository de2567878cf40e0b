"""Raw claim and contract tables derived from the TPC-H style test tables.

The derivation is pure Spark expressions over ``orders`` and ``lineitem``
(one narrow projection each), so the raw tables grow with the inputs and
carry every kind of defect the rules catch: empty keys, non-numeric ids,
values outside the allowed list, impossible dates, negative amounts,
unknown contracts, and the two header misspellings.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Input columns each derivation reads.
CONTRACT_SOURCE_COLUMNS = ["o_orderkey", "o_orderdate"]
CLAIM_SOURCE_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"]


def _txt(c: Column) -> Column:
    return c.cast("string")


def _date_text(c: str) -> Column:
    return F.date_format(F.col(c), "dd.MM.yyyy")


def _stamp_text(c: str) -> Column:
    return F.date_format(F.col(c), "dd.MM.yyyy HH:mm")


def raw_contract(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        F.when(k % 97 == 0, F.lit("")).otherwise(F.concat(F.lit("SYS_"), _txt(k % 3))).alias("SOURCE_SYSTEM"),
        F.when(k % 89 == 0, F.concat(F.lit("abc"), _txt(k))).otherwise(_txt(k)).alias("CONTRACT_ID"),
        F.when(k % 83 == 0, F.lit("Other"))
        .when(k % 4 == 0, F.lit("Direct"))
        .when(k % 4 == 1, F.lit("Reinsurance"))
        .when(k % 4 == 2, F.lit(""))
        .otherwise(F.lit(None).cast("string"))
        .alias("CONTRACT_TYPE"),
        _date_text("o_orderdate").alias("INSURED_PERIOD_FROM"),
        F.when(k % 79 == 0, F.lit("31.02.2020")).otherwise(F.lit("01.01.2099")).alias("INSUDRED_PERIOD_TO"),
        _stamp_text("o_orderdate").alias("CREATION_DATE"),
    )


def raw_claim(lineitem: DataFrame) -> DataFrame:
    ok = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.lit("CLM").alias("SOURCE_SYSTEM"),
        F.concat(
            F.when(flag == "R", F.lit("RX")).when(flag == "A", F.lit("CL")).otherwise(F.lit("CX")),
            F.lit("_"),
            _txt(ok * 10 + ln),
        ).alias("CLAIM_ID"),
        F.when(ok % 11 == 0, F.lit("SYS_9")).otherwise(F.concat(F.lit("SYS_"), _txt(ok % 3))).alias("CONTRACT_SOURCE_SYSTEM"),
        _txt(ok).alias("CONTRAT_ID"),
        F.when((ok + ln) % 61 == 0, F.lit("3"))
        .when(ln % 4 == 0, F.lit(None).cast("string"))
        .when(ln % 4 == 3, F.lit(""))
        .otherwise(_txt(ln % 4))
        .alias("CLAIM_TYPE"),
        _date_text("l_shipdate").alias("DATE_OF_LOSS"),
        F.when((F.col("l_partkey") + ln) % 53 == 0, F.lit("-5"))
        .otherwise(_txt(F.col("l_extendedprice").cast("decimal(16,2)")))
        .alias("AMOUNT"),
        _stamp_text("l_shipdate").alias("CREATION_DATE"),
    )


def raw_claim_by_order(lineitem: DataFrame) -> DataFrame:
    """Claims numbered by their order instead of their line: ids repeat, and
    the orders divisible by 3 share one id."""
    order = F.col("CONTRAT_ID")
    own = F.concat(F.substring("CLAIM_ID", 1, 2), F.lit("_"), order)
    shared = order.cast("long") % 3 == 0
    return raw_claim(lineitem).withColumn("CLAIM_ID", F.when(shared, F.lit("CX_0")).otherwise(own))


class ClaimDigestService:
    """Stands in for a remote digest service, deterministically per key:
    md5 of the id, except numeric part divisible by 7 -> hard failure, by 11
    -> empty answer, by 5 -> one time-out before it answers. Retries of a key
    come back to back, so only the last key's attempt count is kept."""

    def __init__(self):
        self._last: tuple[object, int] = (None, 0)

    def __call__(self, claim_id):
        n = int(str(claim_id).rsplit("_", 1)[-1])
        key, seen = self._last
        seen = seen if key == claim_id else 0
        self._last = (claim_id, seen + 1)
        if n % 7 == 0:
            raise ValueError("rejected")
        if n % 11 == 0:
            return ""
        if n % 5 == 0 and seen == 0:
            raise TimeoutError("slow")
        return hashlib.md5(str(claim_id).encode()).hexdigest()


def no_wait(_seconds: float) -> None:
    return None
