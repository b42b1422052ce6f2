"""Activity marts brought up to date from what has changed.

A mart is kept as a state: per group the sums that add up, and the values that do not. A change of
some transactions takes their old rows out of the sums and puts the new ones in. Values that a
row taken out may have decided - a maximum, a distinct count - are computed again, for the
touched groups alone. A refresh reads the state and the changed rows; of all the other rows only
those of touched groups, and only where a mart has such values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import rate, round_to
from tallymark.schemas import FAILURE_REASONS


@dataclass(frozen=True)
class Rolling:
    """keys: grouping columns. sums: additive values of one row, `rows` always among them.
    again: aggregates that do not add up. finish: mart columns from a state."""

    keys: dict[str, Column]
    sums: dict[str, Column]
    finish: dict[str, Column]
    again: dict[str, Column] = field(default_factory=dict)

    # --- state

    def state(self, rows: DataFrame) -> DataFrame:
        """The state of all rows."""
        return self._keyed(rows).groupBy(*self.keys).agg(
            *[F.sum(f"_{name}").alias(name) for name in self._sums()],
            *[value.alias(name) for name, value in self.again.items()],
        )

    def mart(self, state: DataFrame) -> DataFrame:
        return state.select(*self.keys, *[value.alias(name) for name, value in self.finish.items()])

    def _sums(self) -> dict[str, Column]:
        return {"rows": F.lit(1), **self.sums}

    def _keyed(self, rows: DataFrame) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        values = {f"_{n}": F.coalesce(v.cast("bigint"), zero) for n, v in self._sums().items()}
        return rows.withColumns({**self.keys, **values})

    # --- refresh

    def refresh(self, state: DataFrame, old: DataFrame, new: DataFrame, rows: DataFrame) -> DataFrame:
        """The state after the transactions of `old` have become those of `new`; rows: all that
        is staged now. A group without rows is gone."""
        sums, again = list(self._sums()), list(self.again)
        none = {name: F.lit(None).cast(state.schema[name].dataType) for name in again}

        def signed(part: DataFrame, sign: int) -> DataFrame:
            return self._keyed(part).select(*self.keys, *[(F.col(f"_{n}") * sign).alias(n) for n in sums])

        changed = signed(new, 1).unionByName(signed(old, -1)).groupBy(*self.keys).agg(
            *[F.sum(n).alias(n) for n in sums]
        )
        parts = [
            state.withColumn("kind", F.lit(0)),
            changed.withColumns(none).withColumn("kind", F.lit(1)),
        ]
        if again:
            touched = changed.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
            fresh = self._keyed(rows).join(touched, same, "semi").groupBy(*self.keys)
            fresh = fresh.agg(*[value.alias(name) for name, value in self.again.items()])
            zeros = {n: F.lit(0).cast("bigint") for n in sums}
            parts.append(fresh.withColumns(zeros).withColumn("kind", F.lit(2)))
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part.select(every.columns))

        # the touched groups' own value, else the one that the state has
        def chosen(name: str) -> Column:
            kept, redone = (F.max(F.when(F.col("kind") == kind, F.col(name))) for kind in (0, 2))
            return F.when(F.max("kind") == 0, kept).otherwise(redone).alias(name)

        merged = every.groupBy(*self.keys).agg(
            *[F.sum(n).cast("bigint").alias(n) for n in sums], *[chosen(n) for n in again]
        )
        return merged.where(F.col("rows") > 0).select(state.columns)


def changed_rows(before: DataFrame, after: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old, new) staged rows of the references that a batch names."""
    refs = refs.select("transaction_ref").distinct()
    old, new = (rows.join(refs, "transaction_ref", "semi") for rows in (before, after))
    return old, new


def _known(total: str, count: str) -> Column:
    """A sum over no value is null."""
    return F.when(F.col(count) > 0, F.col(total))


def merchant_daily() -> Rolling:
    """Merchant-days, as `marts.mart_merchant_daily`."""
    amount, fee, success = F.col("amount_ngn_kobo"), F.col("fee_ngn_kobo"), F.col("is_success")
    net, lag = amount - fee, F.col("arrival_lag_seconds")
    measured = {
        "attempted": amount,
        "successful": F.when(success, amount),
        "fees": F.when(success, fee),
        "net": F.when(success, net),
        "lag": lag,
    }
    sums = {
        "successes": success,
        "failures": F.col("status") == "failed",
        "reversals": F.col("is_reversed"),
        **measured,
        **{f"{name}_rows": value.isNotNull() for name, value in measured.items()},
    }
    finish = {
        "attempts": F.col("rows"),
        "successes": F.col("successes"),
        "failures": F.col("failures"),
        "reversals": F.col("reversals"),
        "success_rate": rate(F.col("successes"), F.col("rows"), 4),
        "gross_attempted_kobo": _known("attempted", "attempted_rows"),
        "gross_successful_kobo": _known("successful", "successful_rows"),
        "fees_kobo": _known("fees", "fees_rows"),
        "net_successful_kobo": _known("net", "net_rows"),
        "unique_customers": F.col("unique_customers"),
        "avg_arrival_lag_seconds": round_to(_known("lag", "lag_rows") / F.col("lag_rows"), 1),
        "max_arrival_lag_seconds": F.col("max_lag"),
    }
    again = {"unique_customers": F.count_distinct("customer_id"), "max_lag": F.max("arrival_lag_seconds")}
    keys = {"merchant_id": F.col("merchant_id"), "event_date": F.col("event_date")}
    return Rolling(keys, sums, finish, again)


def channel_performance() -> Rolling:
    """Days by channel, bank and gateway, as `marts.mart_channel_performance`: all of it adds up."""
    failed = {f"fail_{reason}": F.col("failure_reason") == reason for reason in FAILURE_REASONS}
    amount = F.col("amount_ngn_kobo")
    sums = {"successes": F.col("is_success"), "attempted": amount, "attempted_rows": amount.isNotNull(), **failed}
    finish = {
        "attempts": F.col("rows"),
        "successes": F.col("successes"),
        "success_rate": rate(F.col("successes"), F.col("rows"), 4),
        "gross_attempted_kobo": _known("attempted", "attempted_rows"),
        **{name: F.col(name) for name in failed},
    }
    keys = {name: F.col(name) for name in ("event_date", "channel", "bank_code", "gateway")}
    keys["bank_code"] = F.coalesce("bank_code", F.lit("n/a"))
    return Rolling(keys, sums, finish)
