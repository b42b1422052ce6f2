"""Applying a log of analyst actions to the cases.

The log is strictly ordered by `action_id`. Each request is accepted or turned down by
the state its case has at that point, and the first accepted use of an idempotency key
owns the key: a later use replays the owner or conflicts with it.

A case with at most `FAN` actions is walked in their order, as one group. Of longer cases an
action is a map from five states to five states, and maps compose. So the state before every
action is a prefix scan over composed maps, done as a tree: nodes are runs of `FAN` consecutive
action ids of one case, composed bottom up and then walked top down. No group ever holds more
than `FAN` rows, also when one case owns most of the log.

Key ownership depends on which actions were accepted and the other way round. Both are
decided by earlier requests alone, so repeating the scan until no verdict on a key
changes ends in the one answer a sequential run would give. Without clashes that takes
one round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import cleaned_note, valid_case_id, valid_idempotency_key
from tallymark.schemas import (
    ACTIONS,
    ANALYST_STATUSES,
    CASE,
    CASE_ACTION,
    NOTE_REQUIRED,
    TRANSITIONS,
    UNTOUCHED,
)
from tallymark.sources.tables import materialize

STATES = (UNTOUCHED, *ANALYST_STATUSES)
FAN = 1024


def transition_table(spark: SparkSession) -> DataFrame:
    """The twelve legal moves."""
    return spark.createDataFrame(
        list(TRANSITIONS), "current_status string, action string, next_status string"
    )


def next_statuses(moves: DataFrame, current: str, action: str) -> DataFrame:
    """Add `next_status` and `is_legal` to rows of (status, action)."""
    table = _lookup(lambda state, act: _next(state, act))
    target = table[F.concat_ws("/", F.col(current), F.col(action))]
    return moves.withColumn("next_status", target).withColumn("is_legal", target.isNotNull())


def _next(state: str, action: str) -> str | None:
    for current, act, after in TRANSITIONS:
        if (current, act) == (state, action):
            return after
    return None


def _lookup(rule) -> Column:
    pairs = []
    for state in STATES:
        for action in ACTIONS:
            after = rule(state, action)
            if after is not None:
                pairs += [F.lit(f"{state}/{action}"), F.lit(after)]
    return F.create_map(*pairs)


def _ints(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


IDENTITY = tuple(range(len(STATES)))


def _moves() -> Column:
    """Action -> target state per state; an illegal move leaves the state alone."""
    pairs = []
    for action in ACTIONS:
        targets = [_next(s, action) or s for s in STATES]
        pairs += [F.lit(action), _ints(STATES.index(t) for t in targets)]
    return F.create_map(*pairs)


def _legal() -> Column:
    pairs = []
    for action in ACTIONS:
        pairs += [F.lit(action), F.array(*[F.lit(_next(s, action) is not None) for s in STATES])]
    return F.create_map(*pairs)


def _state_number(status: Column) -> Column:
    return (F.array_position(F.array(*[F.lit(s) for s in STATES]), status) - 1).cast("int")


def _state_name(number: Column) -> Column:
    return F.array(*[F.lit(s) for s in STATES])[number]


def states_before(moves: DataFrame, fan: int = FAN) -> DataFrame:
    """`moves` has case_id, action_id, start (state number of the case), move (state map)
    and payload (struct). Returns case_id, action_id, payload and `state`: the state
    number the case has just before the action."""
    # by a hash of the case: cases that share one are counted as one, and may only get a tree
    mark = F.xxhash64("case_id")
    long = moves.groupBy(mark.alias("mark")).count().where(F.col("count") > fan).select("mark")
    long = materialize(long, "long-cases", "zstd")
    if long.isEmpty():
        return _walked(moves)
    marked = moves.withColumn("mark", mark)
    short = _walked(marked.join(long, "mark", "anti").drop("mark"))
    return short.unionByName(_tree(marked.join(long, "mark", "semi").drop("mark"), fan))


def _walked(moves: DataFrame) -> DataFrame:
    """`states_before` of cases with few actions each: a case is one group."""
    kids = F.array_sort(F.collect_list(F.struct("action_id", "move", "payload")))
    cases = moves.groupBy("case_id").agg(kids.alias("kids"), F.max("start").alias("start"))
    pairs = F.explode(F.arrays_zip("kids", _seen(F.col("start")).alias("states")))
    return cases.select("case_id", pairs.alias("pair")).select(
        "case_id",
        F.col("pair.kids.action_id").alias("action_id"),
        F.col("pair.kids.payload").alias("payload"),
        F.col("pair.states").alias("state"),
    )


def _seen(start: Column) -> Column:
    """The states before each of the sorted `kids`, from that before the first."""
    return F.aggregate(
        "kids",
        F.struct(start.alias("now"), _ints([]).alias("seen")),
        lambda acc, kid: F.struct(
            F.get(kid["move"], acc["now"]).alias("now"),
            F.concat(acc["seen"], F.array(acc["now"])).alias("seen"),
        ),
        lambda acc: acc["seen"],
    )


def _tree(moves: DataFrame, fan: int) -> DataFrame:
    """`states_before` by a tree over runs of action ids."""
    low, high = moves.agg(F.min("action_id"), F.max("action_id")).first()
    span = 1 if low is None else high - low + 1
    nodes = moves.withColumn("node", F.col("action_id") - F.lit(low if low is not None else 0))

    def up(children: DataFrame, *extra: str) -> DataFrame:
        parent = F.call_function("div", F.col("node"), F.lit(fan).cast("bigint"))
        kids = F.array_sort(F.collect_list(F.struct(F.col("node").alias("child"), "move", *extra)))
        return children.groupBy("case_id", parent.alias("node")).agg(
            kids.alias("kids"), F.max("start").alias("start")
        )

    def composed(parents: DataFrame) -> DataFrame:
        return parents.select(
            "case_id",
            "node",
            "start",
            F.aggregate(
                "kids",
                _ints(IDENTITY),
                lambda acc, kid: F.transform(acc, lambda s: F.get(kid["move"], s)),
            ).alias("move"),
        )

    def down(parents: DataFrame, *extra: str) -> DataFrame:
        pairs = F.explode(F.arrays_zip("kids", _seen(F.col("state")).alias("states")))
        return parents.select("case_id", pairs.alias("pair")).select(
            "case_id",
            F.col("pair.kids.child").alias("node"),
            F.col("pair.states").alias("state"),
            *[F.col(f"pair.kids.{c}").alias(c) for c in extra],
        )

    levels = [up(nodes, "payload")]
    width = fan
    while width < span:
        levels.append(up(composed(levels[-1])))
        width *= fan

    parents = levels.pop().withColumn("state", F.col("start"))
    while levels:
        entry = down(parents)
        parents = levels.pop().join(entry, ["case_id", "node"])
    leaves = down(parents, "payload")
    return leaves.select(
        "case_id",
        (F.col("node") + F.lit(low if low is not None else 0)).alias("action_id"),
        "payload",
        "state",
    )


@dataclass(frozen=True)
class AppliedActions:
    outcomes: DataFrame  # one row per request
    recorded: DataFrame  # accepted actions, the rows to append to the audit log
    cases: DataFrame  # the case snapshot after the log


def _prepared(cases: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests with their case's state and the verdicts that need no history."""
    known = cases.select(
        "case_id",
        F.lit(True).alias("known"),
        _state_number(F.coalesce("analyst_status", F.lit(UNTOUCHED))).alias("start"),
        F.col("system_fingerprint").alias("fingerprint_at_action"),
    )
    note = cleaned_note(F.col("notes"))
    analyst = cleaned_note(F.col("analyst"))
    refused = (
        F.when(~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False)), "invalid_action")
        .when(~valid_case_id(F.col("case_id")), "case_not_found")
        .when(~valid_idempotency_key(F.col("idempotency_key")), "invalid_key")
        .when(F.col("analyst").isNull(), "analyst_required")
        .when(F.col("known").isNull(), "case_not_found")
    )
    return (
        requests.join(known, "case_id", "left")
        .withColumn("analyst", analyst)
        .withColumn("refused", refused)
        .withColumn(
            "note_missing",
            F.coalesce(F.col("action").isin(*NOTE_REQUIRED), F.lit(False)) & note.isNull(),
        )
        .withColumn("notes", F.coalesce(note, F.lit("")))
    )


def _judge(candidates: DataFrame, fan: int) -> DataFrame:
    """Run every candidate through the state scan; add state, accepted and resulting."""
    columns = [c for c in candidates.columns if c not in ("case_id", "action_id", "start")]
    idle = F.col("blocked") | F.col("note_missing")
    move = F.when(idle, _ints(IDENTITY)).otherwise(_moves()[F.col("action")])
    scanned = states_before(
        candidates.select(
            "case_id",
            "action_id",
            "start",
            move.alias("move"),
            F.struct("start", *columns).alias("payload"),
        ),
        fan,
    ).select("case_id", "action_id", "state", "payload.*")
    legal = F.get(_legal()[F.col("action")], F.col("state"))
    target = _state_name(F.get(_moves()[F.col("action")], F.col("state")))
    accepted = ~F.col("blocked") & ~F.col("note_missing") & legal
    return scanned.withColumns(
        {
            "legal": legal,
            "accepted": accepted,
            "resulting": F.when(accepted, target),
        }
    )


OWNER = ("action_id", "case_id", "action")


def apply_actions(
    cases: DataFrame,
    requests: DataFrame,
    recorded: DataFrame | None = None,
    fan: int = FAN,
) -> AppliedActions:
    """Apply `requests` (ACTION_REQUEST rows) to `cases`; `recorded` is the audit log of
    earlier runs, whose keys are already owned."""
    prepared = materialize(_prepared(cases, requests), "requests", "zstd")
    owner_type = f"struct<{', '.join(f'_{c}:{t}' for c, t in zip(OWNER, ('bigint', 'string', 'string'), strict=True))}>"

    def owners(rows: DataFrame) -> DataFrame:
        return rows.groupBy("idempotency_key").agg(
            F.min(F.struct(*[F.col(c).alias(f"_{c}") for c in OWNER])).alias("owner")
        )

    candidates = prepared.where(F.col("refused").isNull())
    earlier = None
    if recorded is None:
        candidates = candidates.withColumn("owner", F.lit(None).cast(owner_type))
    else:
        # the audit log of all time is read once, and only its owners of keys of this run stay
        keys = candidates.select("idempotency_key").distinct()
        earlier = owners(recorded.select("idempotency_key", *OWNER)).join(keys, "idempotency_key", "semi")
        earlier = materialize(earlier, "earlier-owners", "zstd")
        candidates = candidates.join(earlier, "idempotency_key", "left")
    candidates = candidates.withColumn("blocked", F.col("owner").isNotNull())

    # Only a key that several requests ask for can change hands. Cases without such a key are
    # judged once and never read again.
    wanted = candidates.where(~F.col("blocked")).groupBy("idempotency_key").count().where("count > 1")
    wanted = wanted.select("idempotency_key")
    contended = candidates.where(~F.col("blocked")).join(wanted, "idempotency_key", "semi")
    contended = materialize(contended.select("case_id").distinct(), "contended-cases", "zstd")
    settled = _judge(candidates.join(contended, "case_id", "anti"), fan)
    if contended.isEmpty():
        verdict = materialize(settled, "verdicts", "zstd")
    else:
        judged = _judge(candidates.join(contended, "case_id", "semi").drop("owner"), fan)
        judged = materialize(judged, "judged", "zstd")
        while True:
            taken = judged.where(F.col("accepted")).select("idempotency_key", *OWNER)
            if earlier is not None:
                known = [F.col(f"owner._{c}").alias(c) for c in OWNER]
                taken = taken.unionByName(earlier.select("idempotency_key", *known))
            # both sides are plain scans, so a key with most of the requests can be split
            owned = materialize(owners(taken), "owners", "zstd")
            verdict = judged.join(owned, "idempotency_key", "left").withColumn(
                "now_blocked",
                F.coalesce(F.col("owner._action_id") < F.col("action_id"), F.lit(False)),
            )
            verdict = materialize(verdict, "verdicts", "zstd")
            changed = verdict.where(F.col("blocked") != F.col("now_blocked")).select("case_id").distinct()
            if changed.isEmpty():
                break
            # a case without a changed verdict would fold to the same states again
            again = verdict.join(changed, "case_id", "semi").withColumn("blocked", F.col("now_blocked"))
            again = again.drop("owner", "now_blocked", "state", "legal", "accepted", "resulting")
            rest = verdict.join(changed, "case_id", "anti").drop("owner", "now_blocked")
            judged = materialize(rest.unionByName(_judge(again, fan)), "judged", "zstd")
        verdict = materialize(verdict.drop("now_blocked").unionByName(settled), "verdicts", "zstd")

    same = (F.col("owner._case_id") == F.col("case_id")) & (
        F.col("owner._action") == F.col("action")
    )
    outcome = (
        F.when(F.col("blocked") & same, "replayed")
        .when(F.col("blocked"), "conflict")
        .when(F.col("note_missing"), "missing_note")
        .when(~F.col("legal"), "invalid_transition")
        .otherwise("accepted")
    )
    result = F.when(F.col("resulting") != UNTOUCHED, F.col("resulting"))
    judged_rows = verdict.select(
        "action_id",
        "case_id",
        "action",
        "idempotency_key",
        outcome.alias("outcome"),
        result.alias("resulting_status"),
        F.when(F.col("blocked") & same, F.col("owner._action_id")).alias("replay_of"),
    )
    refused_rows = prepared.where(F.col("refused").isNotNull()).select(
        "action_id", "case_id", "action", "idempotency_key", F.col("refused").alias("outcome")
    )
    outcomes = judged_rows.unionByName(refused_rows, allowMissingColumns=True)

    accepted = verdict.where(F.col("accepted"))
    new_log = accepted.select(
        *[result.alias(c) if c == "resulting_status" else F.col(c) for c in CASE_ACTION.names]
    )
    last = (
        accepted.groupBy("case_id")
        .agg(F.max(F.struct("action_id", "resulting", "fingerprint_at_action")).alias("last"))
        .select("case_id", "last")
    )
    decided = F.col("last.resulting")
    status = F.when(decided != UNTOUCHED, decided)
    touched = F.col("last").isNotNull()
    updated = (
        cases.join(last, "case_id", "left")
        .withColumn("analyst_status", F.when(touched, status).otherwise(F.col("analyst_status")))
        .withColumn(
            "decided_fingerprint",
            F.when(touched, F.when(status.isNotNull(), F.col("last.fingerprint_at_action")))
            .otherwise(F.col("decided_fingerprint")),
        )
        .select(*CASE.names)
    )
    return AppliedActions(outcomes, new_log, updated)
