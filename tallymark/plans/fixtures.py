"""Event streams derived from the given tables by arithmetic on their keys.

Nothing is random, so a SQL engine reading the same tables derives the same rows.
`faulty=True` adds the faults the checks exist for: orphan lines, settlement-time rate
drift, same-instant status ties, a second line for one charge, a missing rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import fee_kobo, payout_id, publisher_id, run_key
from tallymark.operators.cases import break_feed
from tallymark.schemas import ACTION_REQUEST, FAILURE_REASONS, SETTLEMENT_EVENT, TRANSACTION_EVENT

EPOCH = 1_704_067_200  # 2024-01-01 00:00:00 UTC
DAY = 86_400
INGESTED = EPOCH + 14 * DAY + 6 * 3600
LINES_INGESTED = EPOCH + 16 * DAY + 6 * 3600
WATERMARK = EPOCH + 16 * DAY - 1

#: Orders, and order lines, whose events one task makes: about 200 MB to sort.
ORDERS_A_TASK = 100_000
LINES_A_TASK = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(left: Column, right: int) -> Column:
    return F.call_function("div", left, F.lit(right).cast("bigint"))


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _tx_ref(k: Column) -> Column:
    return _padded("TX_", k, 10)


def _line_ref(k: Column, faulty: bool) -> Column:
    """The reference that settlement lines of an order name."""
    if not faulty:
        return _tx_ref(k)
    orphan = F.concat(F.lit("TX_ORPHAN_"), k.cast("string"))
    return F.when(k % 211 == 0, orphan).otherwise(_tx_ref(k))


def tasks_for(orders: DataFrame, lineitem: DataFrame | None = None) -> int:
    """Tasks that events are made in: bounded by rows, whatever the size of the files."""
    tasks = [orders.sparkSession.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_A_TASK)]
    if lineitem is not None:
        tasks.append(-(-lineitem.count() // LINES_A_TASK))
    return max(tasks)


def by_ref(rows: DataFrame, ref: Column, tasks: int) -> DataFrame:
    """Rows dealt by the reference made from their key, as a topic keyed by reference is.

    Only the given columns move. The events made from them, many times as wide, stay where they
    are, and whatever groups them by reference finds them together. An order has a few lines, so no
    reference is large here.
    """
    return rows.repartition(tasks, ref)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice")


def charges_by_ref(orders: DataFrame, tasks: int, faulty: bool = False) -> DataFrame:
    """The charges, dealt by their reference."""
    ref = _tx_ref(F.col("o_orderkey"))
    return charges(by_ref(orders.select(*ORDER_COLUMNS), ref, tasks), faulty)


def charges(orders: DataFrame, faulty: bool = False) -> DataFrame:
    """One charge per order."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    m, slot = cust % 40, k % 20
    is_usd = slot == 0
    confirm = 5 + k % 90
    if faulty:
        confirm = F.when(k % 60 == 4, 0).otherwise(confirm)
    keyed = orders.select(
        k.alias("k"),
        _tx_ref(k).alias("transaction_ref"),
        _padded("MRC_", m, 4).alias("merchant_id"),
        _padded("CUS_", cust, 6).alias("customer_id"),
        F.when(k % 2 == 0, "gateway_a").otherwise("gateway_b").alias("gateway"),
        F.when(slot <= 8, "card")
        .when(slot <= 14, "bank_transfer")
        .when(slot <= 17, "ussd")
        .otherwise("qr")
        .alias("channel"),
        F.when(slot > 8, F.lpad((cust % 14).cast("string"), 3, "0")).alias("bank_code"),
        F.when(is_usd, "USD").otherwise("NGN").alias("currency"),
        F.when(is_usd, F.lit(1615.0) * (F.lit(0.985) + (k % 31) / F.lit(1000.0))).alias(
            "fx_rate_to_ngn"
        ),
        F.round(F.col("o_totalprice") * F.lit(100.0)).cast("bigint").alias("amount_kobo"),
        F.when(m < 31, 1).otherwise(2).alias("settlement_lag_days"),
        (F.lit(EPOCH) + (k % 14) * DAY + (cust * 7919) % DAY).alias("created_s"),
        confirm.alias("confirm_s"),
        F.timestamp_seconds(
            F.lit(WATERMARK) - F.when(cust % 8 == 7, 5 * DAY).otherwise(0)
        ).alias("settlement_source_watermark_at"),
        F.when((k % 100).isin(3, 13, 23, 33, 43, 53, 63, 73), "failed")
        .when(k % 83 == 7, "reversed")
        .when(k % 401 == 9, "pending")
        .otherwise("success")
        .alias("final_status"),
    )
    return keyed.withColumn("fee_kobo", fee_kobo(F.col("amount_kobo"), F.col("channel")))


def transaction_events(charge: DataFrame, faulty: bool = False) -> DataFrame:
    """The status events of each charge, some of them delivered twice."""
    k, final = F.col("k"), F.col("final_status")
    reason = F.array(*[F.lit(r) for r in FAILURE_REASONS])[(k % 6).cast("int")]
    confirmed = F.col("created_s") + F.col("confirm_s")

    # literals by final status: event 0 opens a charge, 1 ends it, 2 reverses it; each code is the
    # number of an event times two, with one added for its second delivery
    def codes(*numbers: int) -> Column:
        once = F.array(*[F.lit(2 * n) for n in numbers])
        twice = F.array(*[F.lit(2 * n + again) for n in numbers for again in (0, 1)])
        return F.when(k % 50 == 1, twice).otherwise(once)

    every = (
        F.when(final == "pending", codes(0)).when(final == "reversed", codes(0, 1, 2)).otherwise(codes(0, 1))
    )
    settled_as = F.when(final == "failed", "failed").otherwise("success")
    number = _div(F.col("code").cast("bigint"), 2)
    fx = F.col("fx_rate_to_ngn")
    if faulty:
        fx = F.when(k % 400 != 0, fx)
    failed = F.when(final == "failed", reason)
    updated = F.when(number == 0, F.col("created_s")).when(number == 1, confirmed).otherwise(confirmed + 21_600)
    rows = charge.withColumn("code", F.explode(every)).withColumns(
        {
            "event_id": F.concat("transaction_ref", F.lit("-"), number.cast("string")),
            "status": F.when(number == 0, "pending").when(number == 1, settled_as).otherwise("reversed"),
            "updated_at": F.timestamp_seconds(updated),
            "event_ts": F.timestamp_seconds(updated),
            "failure_reason": F.when(number == 1, failed).when(number == 2, F.lit("chargeback")),
            "fx_rate_to_ngn": fx,
            "created_at": F.timestamp_seconds("created_s"),
            "ingested_at": F.timestamp_seconds(F.lit(INGESTED) + F.col("code") % 2 * 60),
        }
    )
    return rows.select(*TRANSACTION_EVENT.names)


def settlement_events(
    orders: DataFrame, lineitem: DataFrame, tasks: int, faulty: bool = False
) -> DataFrame:
    """One settlement event per order line, so most lines arrive several times. Both sides are
    dealt by the reference the lines name."""
    k = F.col("k")
    fx = F.col("fx_rate_to_ngn")
    if faulty:
        fx = fx * (F.lit(1.0) + (k % 7 - 3) / F.lit(1000.0))
    is_usd = F.col("currency") == "USD"
    amount = F.when(is_usd, (F.col("amount_kobo") * fx).cast("bigint")).otherwise(
        F.col("amount_kobo")
    )
    fee = F.when(is_usd, (F.col("fee_kobo") * fx).cast("bigint")).otherwise(F.col("fee_kobo"))
    due = F.col("due_kobo")
    percent = F.greatest(F.lit(1).cast("bigint"), _div(due, 100))
    net = (
        F.when(k % 97 == 5, _div(due, 2))
        .when(k % 89 == 6, due - percent)
        .when(k % 71 == 8, due + percent)
        .otherwise(due)
    )
    settlement_ids = F.array(_padded("STL_", k, 10))
    if faulty:
        settlement_ids = F.when(
            k % 500 == 4, F.array(_padded("STL_", k, 10), _padded("STL2_", k, 10))
        ).otherwise(settlement_ids)

    order_key, line_key = F.col("o_orderkey"), F.col("l_orderkey")
    named = by_ref(orders.select(*ORDER_COLUMNS), _line_ref(order_key, faulty), tasks)
    paid = charges(named, faulty).where(
        F.col("final_status").isin("success", "reversed") & (k % 37 != 2)
    ).withColumns(
        {
            "transaction_ref": _line_ref(k, faulty),
            "due_kobo": amount - fee,
            "line_fee": fee,
            "settlement_date": F.date_add(
                F.to_date(F.timestamp_seconds("created_s")), F.col("settlement_lag_days")
            ),
        }
    )
    lines = by_ref(lineitem.select("l_orderkey"), _line_ref(line_key, faulty), tasks)
    delivered = lines.select(_line_ref(line_key, faulty).alias("transaction_ref")).join(
        paid, "transaction_ref"
    )
    rows = delivered.withColumn("settlement_id", F.explode(settlement_ids)).withColumns(
        {
            "event_id": F.concat(F.lit("SEV_"), F.col("settlement_id")),
            "payout_id": payout_id(F.col("merchant_id"), F.col("settlement_date")),
            "net_kobo": net,
            "fee_kobo": F.col("line_fee"),
            "gross_kobo": net + F.col("line_fee"),
            "currency": F.lit("NGN"),
            "settled_at": F.timestamp_seconds(
                F.unix_date("settlement_date").cast("bigint") * DAY + 9 * 3600 + k % 28_800
            ),
            "ingested_at": F.timestamp_seconds(F.lit(LINES_INGESTED)),
        }
    )
    return rows.withColumn("event_ts", F.col("settled_at")).select(*SETTLEMENT_EVENT.names)


def messages(events: DataFrame, topic: str = "transactions") -> DataFrame:
    """The `events` table as JSON messages, a share of them broken in every known way."""
    n = F.col("event_id")
    when = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    number = n.cast("string")
    user = F.col("user_id")
    kobo = F.round(F.abs("value") * F.lit(100.0)).cast("bigint").cast("string")
    kind = n % 50

    merchant = F.when(kind == 3, "").otherwise(
        F.concat(F.lit('"merchant_id":"MRC_'), (user % 40).cast("string"), F.lit('",'))
    )
    amount = F.when(kind == 2, F.concat(F.lit('"'), kobo, F.lit('"'))).otherwise(kobo)
    updated = F.when(kind == 4, "yesterday").otherwise(when)
    padding = F.when(n.isNotNull(), 256_000)  # not foldable into a literal of that size
    document = F.concat(
        F.lit('{"event_id":"EV_'), number,
        F.lit('","event_ts":"'), when,
        F.lit('","transaction_ref":"TX_'), number,
        F.lit('",'), merchant,
        F.lit('"customer_id":"CUS_'), user.cast("string"),
        F.lit('","gateway":"gateway_a","channel":"card","status":"pending","amount_kobo":'),
        amount,
        F.lit(',"fee_kobo":0,"currency":"NGN","settlement_lag_days":1,'),
        F.lit('"settlement_source_watermark_at":"2024-01-16T23:59:59+00:00","created_at":"'), when,
        F.lit('","updated_at":"'), updated,
        F.lit('","added_by_producer":{"event_id":7}}'),
    )
    text = (
        F.when(kind == 0, F.substring(document, 1, 60))
        .when(kind == 1, "[1]")
        .when(kind == 5, F.lit(None).cast("string"))
        .when(kind == 6, "")
        .when(n % 5000 == 7, F.concat(F.lit('{"note":"'), F.repeat(F.lit("x"), padding)))
        .otherwise(document)
    )
    return events.select(text.cast("binary").alias("value"), F.lit(topic).alias("topic"))


# --- Case inputs --------------------------------------------------------------------


def ref_key(ref: Column) -> Column:
    """The order key inside a transaction_ref."""
    return F.substring(ref, 4, 10).cast("bigint")


def first_breaks(recon: DataFrame) -> DataFrame:
    return break_feed(recon).where(ref_key(F.col("transaction_ref")) % 10 != 2)


def second_breaks(recon: DataFrame) -> DataFrame:
    """A later run: some breaks gone, some worse, some new."""
    k = ref_key(F.col("transaction_ref"))
    worse = F.col("exposure_kobo") + F.when(k % 10 == 1, 100).otherwise(0)
    return break_feed(recon).where(k % 10 != 0).withColumn("exposure_kobo", worse.cast("bigint"))


def action_log(breaks: DataFrame) -> DataFrame:
    """Analyst requests on the breaks: legal and illegal moves, blank notes, retries,
    keys reused within a case and across cases, unknown cases."""
    k = ref_key(F.col("transaction_ref"))
    own = F.concat(F.lit("key-"), k.cast("string"))
    shared = F.concat(F.lit("shared-"), _div(k, 1000).cast("string"))
    missing_case = F.sha2(F.concat(F.lit("none:"), F.col("transaction_ref")), 256)

    def request(
        step: int,
        action: str,
        key: Column,
        note: str = "checked",
        case: Column | None = None,
        analyst: str = "ada",
    ) -> Column:
        return F.struct(
            (k * 10 + step).alias("action_id"),
            (F.col("case_id") if case is None else case).alias("case_id"),
            F.lit(analyst).alias("analyst"),
            F.lit(action).alias("action"),
            F.lit(note).alias("notes"),
            key.alias("idempotency_key"),
        )

    one, two = F.concat(own, F.lit("-one")), F.concat(own, F.lit("-two"))
    plans = {
        0: [request(1, "CLOSE", one), request(2, "CLOSE", one)],
        1: [
            request(1, "START_REVIEW", one),
            request(2, "ESCALATE", two),
            request(3, "ESCALATE", two),
        ],
        2: [request(1, "MARK_EXPECTED_DELAY", one), request(2, "CLOSE", one)],
        3: [
            request(1, "CLOSE", shared),
            request(2, "REOPEN", one),
            request(3, "CLOSE", shared),
            request(4, "START_REVIEW", two, analyst="  "),
        ],
        4: [request(1, "REOPEN", one), request(2, "START_REVIEW", one, note="")],
        5: [
            request(1, "CLOSE", one, note="  "),
            request(2, "ESCALATE", one, case=missing_case),
            request(3, "START_REVIEW", F.lit("short")),
        ],
    }
    steps = None
    for remainder, requests in plans.items():
        array = F.array(*requests)
        steps = (
            F.when(k % 6 == remainder, array)
            if steps is None
            else steps.when(k % 6 == remainder, array)
        )
    return (
        breaks.select(F.explode(steps).alias("request"))
        .select("request.*")
        .withColumn("created_at", F.timestamp_seconds(F.lit(INGESTED) + F.col("action_id")))
        .select(*ACTION_REQUEST.names)
    )


# --- Ledger inputs ------------------------------------------------------------------


def chunks(charge: DataFrame) -> DataFrame:
    """Publish units of 1,000 order keys."""
    start = _div(F.col("k"), 1000) * 1000
    key = run_key(F.lit("nightly"), F.lit(1_000_000), F.lit(14), F.lit(42), F.lit(1000))
    return (
        charge.groupBy(start.alias("chunk_start"))
        .agg(
            F.count("*").alias("transactions"),
            F.count_if(F.col("final_status").isin("success", "reversed")).alias("settlements"),
        )
        .select(
            key.alias("run_key"),
            "chunk_start",
            "transactions",
            "settlements",
            F.timestamp_seconds(F.lit(INGESTED) + F.col("chunk_start")).alias("committed_at"),
        )
    )


def ledger(chunk: DataFrame, doubled: bool = False) -> DataFrame:
    """Two thirds of the chunks are committed; some entries twice when `doubled`."""
    number = _div(F.col("chunk_start"), 1000)
    committed = chunk.where(number % 3 != 0)
    if doubled:
        committed = committed.unionByName(committed.where(number % 7 == 1))
    return committed


def run_keys(charge: DataFrame) -> DataFrame:
    key = run_key(
        F.col("merchant_id"),
        F.col("k"),
        F.col("settlement_lag_days"),
        F.col("k") % 100,
        F.lit(50_000),
    )
    return charge.select(
        "transaction_ref", key.alias("run_key"), publisher_id(key).alias("publisher_id")
    )


# --- Broken marts -------------------------------------------------------------------


def _broken(df: DataFrame, k: Column, faults: dict[str, list[tuple[Column, Column]]]) -> DataFrame:
    """Replace a column's value on the rows each fault names."""
    columns = {}
    for name, cases in faults.items():
        value = F.col(name)
        for condition, replacement in reversed(cases):
            value = F.when(condition, replacement).otherwise(value)
        columns[name] = value
    return df.withColumns(columns)


def break_recon(recon: DataFrame) -> DataFrame:
    """The mart with every flag, type and amount rule violated somewhere."""
    k = ref_key(F.col("transaction_ref"))
    slot = k % 13
    text, long_ = "string", "bigint"
    is_break = F.col("is_break")
    overdue = (F.col("reconciliation_status") == "missing_settlement") & (
        F.col("reconciliation_bucket") == "breached_sla"
    )
    matched = F.col("reconciliation_status") == "matched"
    return _broken(
        recon,
        k,
        {
            "break_type": [
                (is_break & (slot == 0), F.lit(None).cast(text)),
                (~is_break & (slot == 1), F.lit("short_paid")),
                (overdue & (slot == 5), F.lit(None).cast(text)),
                (k % 101 == 3, F.lit("unheard_of")),
            ],
            "exposure_kobo": [
                (~is_break & (slot == 2), F.lit(7).cast(long_)),
                (is_break & (slot == 3), F.lit(-1).cast(long_)),
                (overdue & (slot == 5), F.lit(0).cast(long_)),
                (k % 101 == 4, F.lit(None).cast(long_)),
            ],
            "is_break": [
                (matched & (slot == 4), F.lit(True)),
                (overdue & (slot == 5), F.lit(False)),
            ],
            "case_id": [(slot == 6, F.substring("case_id", 1, 63))],
            "outstanding_net_kobo": [(matched & (slot == 7), F.lit(1).cast(long_))],
            "settlement_variance_kobo": [(matched & (slot == 8), F.lit(5).cast(long_))],
            "is_amount_matched": [(matched & (slot == 9), F.lit(False))],
            "source_freshness_status": [
                (
                    (F.col("reconciliation_status") == "missing_settlement") & (slot == 10),
                    F.lit("stale_or_incomplete"),
                )
            ],
            "reconciliation_bucket": [(k % 101 == 5, F.lit("never"))],
            "reconciliation_status": [(k % 101 == 6, F.lit(None).cast(text))],
        },
    )


def break_stg_transactions(stg_tx: DataFrame) -> DataFrame:
    k = ref_key(F.col("transaction_ref"))
    text = "string"
    return _broken(
        stg_tx,
        k,
        {
            "merchant_id": [(k % 101 == 1, F.lit(None).cast(text))],
            "status": [(k % 101 == 2, F.lit("lost"))],
            "channel": [(k % 101 == 3, F.lit("cheque"))],
            "currency": [(k % 101 == 4, F.lit("GBP"))],
            "settlement_lag_days": [(k % 101 == 5, F.lit(3))],
            "amount_ngn_kobo": [(k % 101 == 6, F.lit(None).cast("bigint"))],
            "event_date": [(k % 101 == 7, F.lit(None).cast("date"))],
        },
    )


def break_fct_transactions(fct_tx: DataFrame) -> DataFrame:
    k = ref_key(F.col("transaction_ref"))
    negative = F.lit(-1).cast("bigint")
    return _broken(
        fct_tx,
        k,
        {
            "net_ngn_kobo": [(k % 101 == 1, negative)],
            "fee_ngn_kobo": [(k % 101 == 2, negative)],
            "amount_ngn_kobo": [(k % 101 == 3, negative)],
            "fx_rate_to_ngn": [(k % 60 == 0, F.lit(0.0))],
        },
    )


def break_fct_settlements(fct_stl: DataFrame) -> DataFrame:
    """Lags run backwards on some lines and some lines are lost."""
    n = F.substring("settlement_id", -10, 10).cast("bigint")
    lag = F.when(n % 101 == 4, F.lit(-1).cast("bigint")).otherwise(F.col("settlement_lag_days"))
    return fct_stl.where(n % 103 != 5).withColumn("settlement_lag_days", lag)


def break_success_rate(mart: DataFrame) -> DataFrame:
    """Rates outside [0, 1] where the day of month is 3 or 4."""
    day = F.dayofmonth("event_date")
    rate = (
        F.when(day == 3, F.lit(1.5)).when(day == 4, F.lit(-0.5)).otherwise(F.col("success_rate"))
    )
    return mart.withColumn("success_rate", rate)


def break_cases(cases: DataFrame) -> DataFrame:
    k = ref_key(F.col("transaction_ref"))
    return _broken(
        cases,
        k,
        {
            "exposure_kobo": [(k % 7 == 1, F.lit(-1).cast("bigint"))],
            "amount_ngn_kobo": [(k % 7 == 2, F.lit(-1).cast("bigint"))],
            "break_type": [(k % 7 == 3, F.lit("matched"))],
            "system_status": [(k % 7 == 4, F.lit("MAYBE"))],
            "analyst_status": [(k % 7 == 5, F.lit("LOST"))],
            "case_id": [(k % 7 == 6, F.upper("case_id"))],
        },
    )


def lost_and_doubled(raw: DataFrame) -> DataFrame:
    """A raw layer that lost some deliveries and holds others once too often."""
    k = ref_key(F.col("transaction_ref"))
    kept = raw.where(k % 41 != 1)
    return kept.unionByName(kept.where(k % 43 == 2))
