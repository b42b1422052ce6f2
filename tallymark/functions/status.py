"""Status expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.schemas import FACT_ASSERTING, STATUS_RANK


def status_rank(status: Column) -> Column:
    """Order of statuses that share a timestamp; an unknown status ranks null."""
    pairs = [F.lit(x) for pair in STATUS_RANK.items() for x in pair]
    return F.create_map(*pairs)[status]


def effective_status(analyst: Column, system: Column) -> Column:
    """A person's decision when there is one, else what the data says."""
    return F.coalesce(analyst, system)


def drifted(analyst: Column, decided: Column, current: Column) -> Column:
    """A decision that asserts facts which have since changed. Never null."""
    rests_on_facts = analyst.isin(*FACT_ASSERTING) & decided.isNotNull() & current.isNotNull()
    return F.coalesce(rests_on_facts & (decided != current), F.lit(False))


def cleaned_note(notes: Column) -> Column:
    """Note without surrounding whitespace, null when nothing is left."""
    text = F.regexp_replace(notes, r"^\s+|\s+$", "")
    return F.when(text != "", text)
