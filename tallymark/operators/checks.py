"""Data-quality checks.

A check is a DataFrame of violating rows, empty when all is well. `rule_summary` and
`serving_report` turn checks into one row per rule. Rules of the same kind on one table
share a single pass over it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.schemas import (
    ACTIONS,
    ANALYST_STATUSES,
    BREAK_TYPES,
    CASE,
    CASE_ACTION,
    CHANNELS,
    CURRENCIES,
    FRESHNESS,
    RECONCILIATION_BUCKETS,
    RECONCILIATION_STATUSES,
    SETTLEMENT_LAGS,
    STATUSES,
    SYSTEM_STATUSES,
)
from tallymark.sources.by_reference import KEY, ByReference

# Fixed rules per table.
UNIQUE = (
    ("stg_transactions", "transaction_ref"),
    ("stg_settlements", "settlement_id"),
    ("fct_transactions", "transaction_ref"),
    ("fct_settlements", "settlement_id"),
    ("mart_settlement_reconciliation", "transaction_ref"),
    ("mart_settlement_reconciliation", "case_id"),
)
NOT_NULL = {
    "stg_transactions": (
        "transaction_ref",
        "merchant_id",
        "amount_ngn_kobo",
        "event_date",
        "expected_settlement_date",
        "settlement_source_watermark_at",
    ),
    "stg_settlements": ("settlement_id", "payout_id", "transaction_ref", "net_kobo"),
    "fct_transactions": ("transaction_ref",),
    "fct_settlements": ("settlement_id",),
    "mart_settlement_reconciliation": (
        "transaction_ref",
        "reconciliation_bucket",
        "reconciliation_status",
        "source_freshness_status",
        "expected_net_kobo",
        "outstanding_net_kobo",
        "case_id",
        "is_break",
        "exposure_kobo",
    ),
    "mart_merchant_daily": ("merchant_id", "event_date"),
    "mart_channel_performance": ("event_date",),
}
ACCEPTED = {
    "stg_transactions": {
        "status": STATUSES,
        "channel": CHANNELS,
        "currency": CURRENCIES,
        "settlement_lag_days": SETTLEMENT_LAGS,
    },
    "mart_settlement_reconciliation": {
        "reconciliation_bucket": RECONCILIATION_BUCKETS,
        "reconciliation_status": RECONCILIATION_STATUSES,
        "source_freshness_status": FRESHNESS,
        "break_type": BREAK_TYPES,
    },
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


# --- Generic rules ------------------------------------------------------------------


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. Nulls are the business of not-null."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def check_not_null(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Null count per column, all columns in one pass."""
    return _unpivot(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), columns)


def check_accepted(df: DataFrame, allowed: dict[str, tuple]) -> DataFrame:
    """Count of values outside the allowed set per column; nulls pass."""
    counts = [
        F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)).alias(c)
        for c, values in allowed.items()
    ]
    return _unpivot(df.agg(*counts), tuple(allowed))


def _unpivot(one_row: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return one_row.unpivot([], list(columns), "column_name", "violations")


def _rows_without_match(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key is absent from `others`.

    The search runs on distinct keys of both sides, so a key that owns most of the rows
    costs one row per task. Only the rows of absent keys, normally none, are looked up.
    """
    absent = rows.select(key).distinct().join(others.select(key).distinct(), key, "anti")
    return rows.join(absent, key, "semi")


def check_relationship(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key no parent row has."""
    return _rows_without_match(child.where(F.col(key).isNotNull()), parent, key)


def unique_rules(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            check_unique(tables[t], c)
            .agg(F.count("*").alias("violations"))
            .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "violations")
            for t, c in UNIQUE
        ]
    )


def not_null_rules(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            check_not_null(tables[t], columns).select(
                F.lit(t).alias("table_name"), "column_name", "violations"
            )
            for t, columns in NOT_NULL.items()
        ]
    )


def accepted_rules(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            check_accepted(tables[t], allowed).select(
                F.lit(t).alias("table_name"), "column_name", "violations"
            )
            for t, allowed in ACCEPTED.items()
        ]
    )


# --- Rules of the marts -------------------------------------------------------------


def _break_flags_off() -> Column:
    """Three facts: a row is flagged exactly if it has a type; exactly if it has exposure, of
    zero or more; and matched rows are never, overdue missing ones always flagged. A null on
    either side of a fact breaks it."""
    flag, status = F.col("is_break"), F.col("reconciliation_status")
    exposure = F.col("exposure_kobo")
    overdue = (status == "missing_settlement") & (F.col("reconciliation_bucket") == "breached_sla")
    typed_as_flagged = flag.eqNullSafe(F.col("break_type").isNotNull())
    exposed_as_flagged = F.when(flag, exposure >= 0).otherwise(exposure == 0)
    status_agrees = ~((status == "matched") & flag) & ~(overdue & ~flag)
    named = F.length("case_id") == 64
    facts = [typed_as_flagged, exposed_as_flagged, status_agrees, named]
    return ~reduce(lambda a, b: a & b, [F.coalesce(fact, F.lit(False)) for fact in facts])


def _money_negative() -> Column:
    return _any([F.col(c) < 0 for c in ("net_ngn_kobo", "fee_ngn_kobo", "amount_ngn_kobo")])


def _matched_with_rest() -> Column:
    return F.col("is_amount_matched") & (F.col("outstanding_net_kobo") != 0)


def _settled_early() -> Column:
    return (F.col("settlement_lag_days") < 0) & ~F.col("is_orphan_settlement")


def _rate_outside() -> Column:
    return (F.col("success_rate") < 0) | (F.col("success_rate") > 1)


def _usd_without_rate() -> Column:
    fx = F.col("fx_rate_to_ngn")
    return (F.col("currency") == "USD") & (fx.isNull() | (fx <= 0))


def _matched_off() -> Column:
    off = [
        F.col("settlement_variance_kobo") != 0,
        F.col("outstanding_net_kobo") != 0,
        ~F.col("is_amount_matched"),
    ]
    return (F.col("reconciliation_status") == "matched") & _any(off)


def _stale_missing() -> Column:
    return (F.col("source_freshness_status") == "stale_or_incomplete") & (
        F.col("reconciliation_status") == "missing_settlement"
    )


#: Rules on single rows: table -> rule -> condition of a violation.
ROW_RULES: dict[str, dict[str, Callable[[], Column]]] = {
    "fct_transactions": {"negative_money": _money_negative, "usd_without_rate": _usd_without_rate},
    "fct_settlements": {"settled_before_charge": _settled_early},
    "mart_settlement_reconciliation": {
        "break_flags": _break_flags_off,
        "matched_with_outstanding": _matched_with_rest,
        "inconsistent_matched": _matched_off,
        "stale_but_missing": _stale_missing,
    },
    "mart_merchant_daily": {"success_rate_range": _rate_outside},
    "mart_channel_performance": {"success_rate_range": _rate_outside},
}


def break_flags_inconsistent(recon: DataFrame) -> DataFrame:
    """Rows whose flag, type, exposure and status of a break do not agree."""
    return recon.where(_break_flags_off()).select(
        "transaction_ref", "reconciliation_status", "is_break", "break_type", "exposure_kobo"
    )


def negative_money(fct_tx: DataFrame) -> DataFrame:
    return fct_tx.where(_money_negative()).select(
        "transaction_ref", "amount_ngn_kobo", "fee_ngn_kobo", "net_ngn_kobo"
    )


def matched_with_outstanding(recon: DataFrame) -> DataFrame:
    return recon.where(_matched_with_rest()).select("transaction_ref", "outstanding_net_kobo")


def settled_before_charge(fct_stl: DataFrame) -> DataFrame:
    return fct_stl.where(_settled_early()).select(
        "settlement_id", "transaction_ref", "settlement_lag_days"
    )


def success_rate_out_of_range(daily: DataFrame, channel: DataFrame) -> DataFrame:
    def outside(df: DataFrame, model: str, grain: str) -> DataFrame:
        return df.where(_rate_outside()).select(
            F.lit(model).alias("model"), F.col(grain).alias("grain"), "success_rate"
        )

    return outside(daily, "mart_merchant_daily", "merchant_id").unionByName(
        outside(channel, "mart_channel_performance", "channel")
    )


def usd_without_rate(fct_tx: DataFrame) -> DataFrame:
    """Dollar charges that no positive rate converts."""
    return fct_tx.where(_usd_without_rate()).select(
        "transaction_ref", "currency", "fx_rate_to_ngn", "amount_ngn_kobo"
    )


def inconsistent_matched(recon: DataFrame) -> DataFrame:
    return recon.where(_matched_off()).select(
        "transaction_ref", "settlement_variance_kobo", "outstanding_net_kobo", "is_amount_matched"
    )


def amount_discrepancies(recon: DataFrame) -> DataFrame:
    """Soft signal: settled rows whose amount is off, by currency."""
    settled = F.col("is_settled")
    ngn = (F.col("currency") == "NGN") & settled & ~F.col("is_amount_matched")
    usd = (F.col("currency") == "USD") & settled & (F.col("settlement_variance_kobo") != 0)
    return recon.agg(
        F.count_if(ngn).alias("ngn_amount_discrepancies"),
        F.count_if(usd).alias("usd_rows_with_variance"),
    )


def expected_mart_rows(fct_tx: DataFrame, fct_stl: DataFrame) -> DataFrame:
    """Rows the reconciliation mart must have, counted from the facts alone."""
    settled_refs = fct_stl.select("transaction_ref").distinct()
    success = fct_tx.where(F.col("is_settlement_eligible")).select("transaction_ref")
    reversed_ = (
        fct_tx.where(F.col("is_reversed"))
        .select("transaction_ref")
        .join(settled_refs, "transaction_ref", "semi")
    )
    return success.unionByName(reversed_).agg(F.count("*").alias("expected_rows"))


def expected_mart_rows_by_reference(layout: ByReference) -> DataFrame:
    """The same count from the staged tables, which lie together by reference: no exchange but
    that of the counts."""
    settled = layout.lines.select(*KEY).distinct()
    settled_or_not = layout.charges.join(settled.withColumn("settled", F.lit(True)), list(KEY), "left")
    owns = F.coalesce(F.col("settled"), F.lit(False)) | (F.col("ref_slots") > 1)
    due = F.col("is_settlement_eligible") | (F.col("is_reversed") & owns)
    return settled_or_not.where(F.col("ref_slot") == 0).agg(F.count_if(due).alias("expected_rows"))


def mart_row_delta(recon: DataFrame, expected: DataFrame) -> DataFrame:
    """recon against the one row of `expected_mart_rows`."""
    rows = recon.agg(F.count("*").alias("reconciliation_rows"))
    both = rows.withColumn("expected_rows", expected.scalar())
    return both.withColumn("row_delta", F.col("reconciliation_rows") - F.col("expected_rows"))


def settled_without_line(recon: DataFrame, fct_stl: DataFrame) -> DataFrame:
    settled = recon.where(F.col("is_settled")).select("transaction_ref", "settlement_id")
    return _rows_without_match(settled, fct_stl, "transaction_ref")


def daily_ties_to_fact(daily: DataFrame, fct_tx: DataFrame) -> DataFrame:
    attempts = daily.agg(F.sum("attempts").alias("daily_attempts"))
    both = attempts.withColumn(
        "fact_rows", fct_tx.agg(F.count("*").alias("fact_rows")).scalar()
    )
    return both.withColumn("difference", F.col("daily_attempts") - F.col("fact_rows"))


def stale_but_missing(recon: DataFrame) -> DataFrame:
    """A stale source can only ever say unverified."""
    return recon.where(_stale_missing()).select(
        "transaction_ref", "source_freshness_status", "reconciliation_status"
    )


# --- All rules at once, the gate before publishing ----------------------------------


def _rules_of(table: str) -> dict[str, Column]:
    """Conditions of a violation for every rule that looks at single rows of a table."""
    rules = {f"not_null_{c}": F.col(c).isNull() for c in NOT_NULL.get(table, ())}
    for column, values in ACCEPTED.get(table, {}).items():
        rules[f"accepted_{column}"] = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return rules | {name: rule() for name, rule in ROW_RULES.get(table, {}).items()}


def _keys_grouped(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """(key, one count of rows for each table): all tables meet in one exchange, reduced to a
    row per key and task before it. Of the transactions the eligible and reversed ones are
    counted along."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    kinds = {"eligible": "is_settlement_eligible", "reversed": "is_reversed"}

    def marked(name: str, column: str) -> DataFrame:
        charge = name == "fct_transactions" and column == "transaction_ref"
        kind = {k: F.col(c).cast("bigint") if charge else none for k, c in kinds.items()}
        return tables[name].select(
            F.col(column).alias("key"),
            *[(one if name == other else none).alias(other) for other in keys],
            *[F.coalesce(c, none).alias(k) for k, c in kind.items()],
        )

    rows = _union([marked(name, column) for name, column in keys.items()])
    return rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in (*keys, *kinds)])


def _per_ref(tables: dict[str, DataFrame]) -> DataFrame:
    grouped = _keys_grouped(tables, dict.fromkeys(tables, "transaction_ref"))
    return grouped.withColumnRenamed("key", "transaction_ref")


def _expected_rows() -> list[Column]:
    """Over `_per_ref` with both facts: their rows and those that the mart must have. A null
    ref names no charge."""
    zero = F.lit(0).cast("bigint")
    settled = F.col("transaction_ref").isNotNull() & (F.col("fct_settlements") > 0)
    due = F.col("eligible") + F.when(settled, F.col("reversed")).otherwise(zero)
    return [
        F.coalesce(F.sum("fct_transactions"), zero).alias("fct_tx_rows"),
        F.coalesce(F.sum("fct_settlements"), zero).alias("fct_stl_rows"),
        F.coalesce(F.sum(due), zero).alias("expected_rows"),
    ]


def _row_tests(df: DataFrame, table: str) -> DataFrame | None:
    """(table_name, rule, violations) of the rules on single rows: one scan, nothing grouped."""
    rules = _rules_of(table)
    if not rules:
        return None
    row = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    tests = row.unpivot([], row.columns, "rule", "violations")
    return tests.select(F.lit(table).alias("table_name"), "rule", "violations")


REFS = (
    "stg_transactions",
    "stg_settlements",
    "fct_transactions",
    "fct_settlements",
    "mart_settlement_reconciliation",
)
RECON, DAILY = "mart_settlement_reconciliation", "mart_merchant_daily"


def data_tests(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per data test over staged tables, facts and marts.

    Rules on single rows take one scan of each table. All that goes by reference - unique
    references, lines without a charge, the rows the mart must have - comes from one grouping
    over the union of five tables, unique line and case ids from another: two exchanges of
    narrow rows, whatever the number of tests.
    """
    refs = _per_ref({name: tables[name] for name in REFS})
    named, zero = F.col("transaction_ref").isNotNull(), F.lit(0).cast("bigint")
    orphans = F.when(named & (F.col("stg_transactions") == 0), F.col("stg_settlements"))
    by_ref = refs.agg(
        *[F.count_if(named & (F.col(t) > 1)).alias(f"{t}.unique_{c}") for t, c in UNIQUE if c == "transaction_ref"],
        F.coalesce(F.sum(orphans), zero).alias("stg_settlements.line_has_charge"),
        F.coalesce(F.sum(RECON), zero).alias("recon_rows"),
        *_expected_rows(),
    )
    ids = {table: column for table, column in UNIQUE if column != "transaction_ref"}
    known = F.col("key").isNotNull()
    by_id = _keys_grouped(tables, ids).agg(
        *[F.count_if(known & (F.col(t) > 1)).alias(f"{t}.unique_{c}") for t, c in ids.items()]
    )
    attempts = tables[DAILY].agg(F.coalesce(F.sum("attempts"), zero).alias("attempts"))
    # one-row relations side by side: each column is known in exactly one of them
    sides = [by_ref, by_id, attempts]
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    one = wide.agg(*[F.max(f"`{c}`").alias(c) for c in wide.columns])
    counts = one.select(
        *[F.col(f"`{c}`") for c in wide.columns if "." in c],
        F.abs(F.col("recon_rows") - F.col("expected_rows")).alias(f"{RECON}.ties_to_fact"),
        F.abs(F.col("attempts") - F.col("fct_tx_rows")).alias(f"{DAILY}.ties_to_fact"),
    )
    counts = counts.toDF(*[c.replace(".", "/") for c in counts.columns])
    keyed = counts.unpivot([], counts.columns, "test", "violations").select(
        F.substring_index("test", "/", 1).alias("table_name"),
        F.substring_index("test", "/", -1).alias("rule"),
        "violations",
    )
    single = [_row_tests(df, name) for name, df in tables.items()]
    return _union([*[tests for tests in single if tests is not None], keyed])


def require_data_tests(tables: dict[str, DataFrame]) -> None:
    """Raise if any data test has a violation."""
    failed = data_tests(tables).where(F.col("violations") > 0).collect()  # a row per test
    if failed:
        names = ", ".join(sorted(f"{r['table_name']}.{r['rule']}={r['violations']}" for r in failed))
        raise RuntimeError(f"{len(failed)} data test(s) failed: {names}")


# --- Report over the served tables --------------------------------------------------


def _recon_counts(recon: DataFrame) -> DataFrame:
    """Rows and every per-row rule of the reconciliation mart, in one scan."""
    settled = F.col("is_settled")
    ngn_off = (F.col("currency") == "NGN") & settled & ~F.col("is_amount_matched")
    usd_off = (F.col("currency") == "USD") & settled & (F.col("settlement_variance_kobo") != 0)
    return recon.agg(
        F.count("*").alias("recon_rows"),
        F.count_if(_matched_with_rest()).alias("matched_rows_zero_outstanding"),
        F.count_if(_matched_off()).alias("matched_reconciliation_consistency"),
        F.count_if(ngn_off).alias("ngn_amount_discrepancies"),
        F.count_if(usd_off).alias("usd_rows_with_variance"),
    )


def _fact_counts(fct_tx: DataFrame, fct_stl: DataFrame) -> DataFrame:
    """Rows of both facts, refs with copies and the rows the mart must have, from one grouping
    by ref over the union of both."""
    return _per_ref({"fct_transactions": fct_tx, "fct_settlements": fct_stl}).agg(
        *_expected_rows(),
        F.count_if((F.col("fct_transactions") > 1) & F.col("transaction_ref").isNotNull()).alias(
            "fct_transactions_unique_ref"
        ),
    )


def serving_report(tables: dict[str, DataFrame], rows: dict[str, int] | None = None) -> DataFrame:
    """One row per check with its severity, count and outcome.

    Tables that no rule looks into are only counted, and not read at all where their rows
    are known from writing them (`rows`).
    """
    recon = tables["mart_settlement_reconciliation"]
    parts = [_recon_counts(recon), _fact_counts(tables["fct_transactions"], tables["fct_settlements"])]
    others = [n for n in tables if n.startswith("mart_") and tables[n] is not recon]
    for name in others:
        if rows is not None and name in rows:
            parts[0] = parts[0].withColumn(name, F.lit(rows[name]).cast("bigint"))
        else:
            parts.append(tables[name].agg(F.count("*").alias(name)))
    # one-row relations side by side: each column is known in exactly one of them
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = wide.agg(*[F.max(c).alias(c) for c in wide.columns])

    def empty(column: str) -> Column:
        return (F.col(column) == 0).cast("bigint")

    rules = {
        "mart_settlement_reconciliation_non_empty": empty("recon_rows"),
        "fct_transactions_non_empty": empty("fct_tx_rows"),
        "fct_settlements_non_empty": empty("fct_stl_rows"),
        **{f"{name}_non_empty": empty(name) for name in others},
        "reconciliation_ties_to_fact": F.abs(F.col("recon_rows") - F.col("expected_rows")),
        **{
            name: F.col(name)
            for name in (
                "fct_transactions_unique_ref",
                "matched_rows_zero_outstanding",
                "matched_reconciliation_consistency",
                "ngn_amount_discrepancies",
                "usd_rows_with_variance",
            )
        },
    }
    counts = one.select(*[rule.alias(name) for name, rule in rules.items()])
    soft = F.col("check_name").isin("ngn_amount_discrepancies", "usd_rows_with_variance")
    return (
        counts.unpivot([], counts.columns, "check_name", "violations")
        .withColumn("severity", F.when(soft, "soft").otherwise("hard"))
        .withColumn(
            "outcome",
            F.when(F.col("violations") == 0, "pass")
            .when(F.col("severity") == "soft", "warn")
            .otherwise("fail"),
        )
        .select("check_name", "severity", "violations", "outcome")
    )


def enforce(report: DataFrame) -> tuple[list, list]:
    """Raise on a hard failure; return (hard, soft) rows otherwise. One row per check."""
    rows = report.where(F.col("outcome") != "pass").collect()
    hard = [r for r in rows if r["severity"] == "hard"]
    soft = [r for r in rows if r["severity"] == "soft"]
    if hard:
        names = ", ".join(f"{r['check_name']}={r['violations']}" for r in hard)
        raise RuntimeError(f"{len(hard)} check(s) failed: {names}")
    return hard, soft


# --- Bags of ids and the chunk ledger -----------------------------------------------


def bag_counts(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Copies of each key on both sides. Both sides go through one aggregate instead of
    a join, so each task sends one row per key however often a key repeats."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return (
        expected.select(key, one.alias("expected"), none.alias("found"))
        .unionByName(found.select(key, none.alias("expected"), one.alias("found")))
        .groupBy(key)
        .agg(F.sum("expected").alias("expected"), F.sum("found").alias("found"))
    )


def compare_bags(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected, found, extra and missing copies over the expected keys."""
    counts = bag_counts(expected, found, key).where(F.col("expected") > 0)
    surplus = F.col("found") - F.col("expected")
    zero = F.lit(0).cast("bigint")
    totals = counts.agg(
        F.coalesce(F.sum("expected"), zero).alias("expected"),
        F.coalesce(F.sum("found"), zero).alias("found"),
        F.coalesce(F.sum(F.greatest(zero, surplus)), zero).alias("extra"),
        F.coalesce(F.sum(F.greatest(zero, -surplus)), zero).alias("missing"),
    )
    return totals.withColumn("exact", (F.col("extra") == 0) & (F.col("missing") == 0))


def bag_difference(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys with more copies on one side, the side and the number of copies it has more."""
    surplus = F.col("found") - F.col("expected")
    return (
        bag_counts(expected, found, key)
        .where(surplus != 0)
        .select(
            key,
            F.when(surplus > 0, "extra").otherwise("missing").alias("side"),
            F.abs(surplus).alias("copies"),
        )
    )


def duplicate_ledger_rows(ledger: DataFrame) -> DataFrame:
    counts = ledger.groupBy("run_key", "chunk_start").agg(F.count("*").alias("copies"))
    return counts.groupBy("run_key").agg(
        (F.sum("copies") - F.count("*")).alias("duplicate_rows")
    )


# --- Constraints of the case store --------------------------------------------------


CASE_KEYS = ("case_id", "display_id", "transaction_ref")


def _required(df: DataFrame, schema: StructType) -> dict[str, Column]:
    """A rule per required column: a null passes every other rule, so it needs its own."""
    return {
        f"{field.name}_present": F.col(field.name).isNull()
        for field in schema
        if not field.nullable and field.name in df.columns
    }


def case_rules() -> dict[str, Column]:
    """Conditions under which a case must not be published."""
    return {
        "case_id_format": ~F.col("case_id").rlike(r"\A[0-9a-f]{64}\z"),
        "amount_not_negative": F.col("amount_ngn_kobo") < 0,
        "exposure_not_negative": F.col("exposure_kobo") < 0,
        "break_type_known": ~F.col("break_type").isin(*BREAK_TYPES),
        "system_status_known": ~F.col("system_status").isin(*SYSTEM_STATUSES),
        "analyst_status_known": ~F.col("analyst_status").isin(*ANALYST_STATUSES),
        "decision_has_fingerprint": F.col("analyst_status").isNull()
        != F.col("decided_fingerprint").isNull(),
        **{f"{field.name}_present": F.col(field.name).isNull() for field in CASE if not field.nullable},
    }


def case_constraint_violations(cases: DataFrame) -> DataFrame:
    """Rows that must not be published, with the constraint each one breaks."""
    return _violations(cases, "case_id", case_rules())


def broken_cases() -> Column:
    """How many rows break a constraint, to be counted while they are written."""
    return F.count_if(_any([F.coalesce(rule, F.lit(False)) for rule in case_rules().values()]))


def action_constraint_violations(actions: DataFrame) -> DataFrame:
    rules = {
        "analyst_present": F.trim(F.coalesce("analyst", F.lit(""))) == "",
        "action_known": ~F.col("action").isin(*ACTIONS),
        "key_length": ~F.length("idempotency_key").between(8, 128),
    }
    return _violations(actions, "action_id", _required(actions, CASE_ACTION) | rules)


def case_key_violations(cases: DataFrame) -> DataFrame:
    """Keys of the case table that two rows share, all keys in one pass."""
    keys = [F.struct(F.lit(k).alias("key_name"), F.col(k).alias("key_value")) for k in CASE_KEYS]
    return (
        cases.select(F.explode(F.array(*keys)).alias("key"))
        .select("key.*")
        .where(F.col("key_value").isNotNull())
        .groupBy("key_name", "key_value")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def action_key_violations(actions: DataFrame, cases: DataFrame) -> DataFrame:
    """Idempotency keys used twice, and actions on a case that does not exist."""
    twice = check_unique(actions, "idempotency_key").select(
        F.lit("idempotency_key_unique").alias("constraint_name"),
        F.col("idempotency_key").alias("key_value"),
    )
    orphans = check_relationship(actions, cases, "case_id").select(
        F.lit("action_has_case").alias("constraint_name"), F.col("case_id").alias("key_value")
    )
    return twice.unionByName(orphans.distinct())


def _violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    names = F.array_compact(
        F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    )
    return df.select(key, F.explode(names).alias("constraint_name"))


def removed_audit_rows(old_log: DataFrame, new_log: DataFrame) -> DataFrame:
    """Rows of the old log that the new one lacks or has changed, with the copies it lacks."""
    columns = old_log.columns
    row = F.struct(*columns).alias("row")
    lost = bag_difference(old_log.select(row), new_log.select(*columns).select(row), "row")
    return lost.where(F.col("side") == "missing").select("row.*", "copies")
