"""Column helpers. All are built-in expressions; none is a UDF."""

from tallymark.functions.identity import (
    case_id,
    display_id,
    fingerprint,
    payout_id,
    publisher_id,
    run_key,
    valid_case_id,
    valid_idempotency_key,
)
from tallymark.functions.money import fee_kobo, format_naira, naira, rate, round_to, to_ngn_kobo
from tallymark.functions.status import cleaned_note, drifted, effective_status, status_rank

__all__ = [
    "case_id",
    "cleaned_note",
    "display_id",
    "drifted",
    "effective_status",
    "fee_kobo",
    "fingerprint",
    "format_naira",
    "naira",
    "payout_id",
    "publisher_id",
    "rate",
    "round_to",
    "run_key",
    "status_rank",
    "to_ngn_kobo",
    "valid_case_id",
    "valid_idempotency_key",
]
