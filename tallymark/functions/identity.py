"""Identifiers and format checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats.
CASE_PREFIX = "case:v1:"
CASE_ID_FORMAT = r"\A[0-9a-f]{64}\z"
IDEMPOTENCY_KEY_FORMAT = r"\A[A-Za-z0-9._:-]{8,128}\z"
PUBLISHER_PREFIX = "settlement-generator-"


def case_id(transaction_ref: Column) -> Column:
    return F.sha2(F.concat(F.lit(CASE_PREFIX), transaction_ref), 256)


def display_id(case: Column) -> Column:
    """A case as a console shows it; 64 bits of the id, so two cases may look alike."""
    return F.concat(F.lit("CASE-"), F.upper(F.substring(case, 1, 16)))


def fingerprint(break_type: Column, exposure_kobo: Column) -> Column:
    """Kind and size of a break as one text; a case has drifted once it reads differently."""
    return F.concat(break_type, F.lit(":"), exposure_kobo.cast("string"))


def payout_id(merchant_id: Column, settlement_date: Column) -> Column:
    return F.concat(
        F.lit("PYO_"), merchant_id, F.lit("_"), F.date_format(settlement_date, "yyyyMMdd")
    )


def run_key(run_id: Column, n: Column, days: Column, seed: Column, chunk: Column) -> Column:
    """A run id with everything that decides what its chunks hold: equal keys, equal chunks."""
    return F.concat(
        run_id,
        F.lit("|n="), n.cast("string"),
        F.lit("|days="), days.cast("string"),
        F.lit("|seed="), seed.cast("string"),
        F.lit("|chunk="), chunk.cast("string"),
    )


def publisher_id(key: Column) -> Column:
    """Bounded-length id for one run key, the same on every retry of the run."""
    return F.concat(F.lit(PUBLISHER_PREFIX), F.substring(F.sha2(key, 256), 1, 24))


def valid_case_id(case: Column) -> Column:
    return F.coalesce(case.rlike(CASE_ID_FORMAT), F.lit(False))


def valid_idempotency_key(key: Column) -> Column:
    return F.coalesce(key.rlike(IDEMPOTENCY_KEY_FORMAT), F.lit(False))
