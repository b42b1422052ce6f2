import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tallymark.operators import coerce as co
from tallymark.schemas import QUARANTINE_MAX_BYTES, SETTLEMENT_EVENT, TRANSACTION_EVENT, nullable
from tallymark.sources.tables import read_raw
from tallymark.sources.topics import file_messages
from tallymark.streaming.drain import Dataset, commits, drain, ingest

STAMP = datetime(2024, 1, 15, 6, tzinfo=UTC)
GOOD_LINE = {
    "event_id": "e1",
    "event_ts": "2024-01-02T10:15:30+00:00",
    "settlement_id": "s1",
    "payout_id": "p1",
    "merchant_id": "m1",
    "transaction_ref": "t1",
    "gross_kobo": 110,
    "fee_kobo": 10,
    "net_kobo": 100,
    "currency": "NGN",
    "settlement_date": "2024-01-02",
    "settled_at": "2024-01-02T11:15:30+01:00",
    "added_by_producer": {"net_kobo": "x"},
}


def without(key):
    return {k: v for k, v in GOOD_LINE.items() if k != key}


def run(spark, payloads):
    rows = [(p.encode() if isinstance(p, str) else p, "lines") for p in payloads]
    messages = spark.createDataFrame(rows, "value binary, topic string")
    return co.coerce(messages, SETTLEMENT_EVENT)


FAULTS = [
    (json.dumps(GOOD_LINE), None),
    (" \n" + json.dumps(GOOD_LINE) + "  ", None),
    (json.dumps({**GOOD_LINE, "net_kobo": 100.0}), None),
    (json.dumps({**GOOD_LINE, "net_kobo": 100.5}), "SchemaMismatch"),
    (json.dumps({**GOOD_LINE, "net_kobo": "100"}), "SchemaMismatch"),
    (json.dumps({**GOOD_LINE, "net_kobo": True}), "SchemaMismatch"),
    (json.dumps({**GOOD_LINE, "net_kobo": 10**19}), "SchemaMismatch"),
    (json.dumps({**GOOD_LINE, "payout_id": 7}), "SchemaMismatch"),
    (json.dumps({**GOOD_LINE, "settled_at": "soon"}), "ValueError"),
    (json.dumps({**GOOD_LINE, "settled_at": "2024"}), "ValueError"),
    (json.dumps({**GOOD_LINE, "settled_at": 5}), "TypeError"),
    (json.dumps({**GOOD_LINE, "payout_id": None}), "MissingRequired"),
    (json.dumps(without("payout_id")), "MissingRequired"),
    (json.dumps(GOOD_LINE) + "x", "JSONDecodeError"),
    (json.dumps(GOOD_LINE) + "," + json.dumps(GOOD_LINE), "JSONDecodeError"),
    (json.dumps(GOOD_LINE)[:40], "JSONDecodeError"),
    ("[" + json.dumps(GOOD_LINE) + "]", "AttributeError"),
    ("null", "AttributeError"),
    ("3", "AttributeError"),
    ("", "JSONDecodeError"),
    (None, "TypeError"),
    (b'{"event_id":"\xff"}', "UnicodeDecodeError"),
]


def test_each_fault_gets_its_name(spark):
    rows = [
        (p.encode() if isinstance(p, str) else p, str(i)) for i, (p, _) in enumerate(FAULTS)
    ]
    messages = spark.createDataFrame(rows, "value binary, topic string")
    found = co.coerce(messages, SETTLEMENT_EVENT).select("topic", "error_type").collect()
    assert {int(r[0]): r[1] for r in found} == {i: e for i, (_, e) in enumerate(FAULTS)}


def test_record_is_typed_and_undeclared_fields_are_dropped(spark):
    good = co.accepted(run(spark, [json.dumps(GOOD_LINE)]), SETTLEMENT_EVENT, F.lit(STAMP))
    row = good.first()
    assert good.columns == SETTLEMENT_EVENT.names
    assert [f.dataType for f in good.schema] == [f.dataType for f in SETTLEMENT_EVENT]
    assert row["net_kobo"] == 100
    assert str(row["settlement_date"]) == "2024-01-02"
    seconds = good.select(F.unix_timestamp("settled_at")).first()[0]
    assert seconds == int(datetime(2024, 1, 2, 10, 15, 30, tzinfo=UTC).timestamp())


def test_absent_optional_fields_are_null(spark):
    message = spark.createDataFrame(
        [(b'{"transaction_ref": "t", "merchant_id": "m"}', "x")], "value binary, topic string"
    )
    record = co.coerce(message, TRANSACTION_EVENT).first()["record"]
    assert record["transaction_ref"] == "t"
    assert record["amount_kobo"] is None and record["bank_code"] is None


def test_quarantine_is_bounded_in_bytes_and_keeps_no_parser_text(spark):
    wide = ("é" * QUARANTINE_MAX_BYTES).encode()
    bad = co.quarantined(
        run(spark, [wide, b"x" * QUARANTINE_MAX_BYTES, b'{"token=secret', b"\xff{"]), F.lit(STAMP)
    )
    assert set(bad.columns) == {
        "source_topic",
        "ingested_at",
        "error_type",
        "raw_payload",
        "payload_truncated",
    }
    rows = bad.collect()
    assert [r["payload_truncated"] for r in rows] == [True, False, False, False]
    assert len(rows[0]["raw_payload"].encode()) <= QUARANTINE_MAX_BYTES
    assert len(rows[1]["raw_payload"]) == QUARANTINE_MAX_BYTES
    assert rows[2]["error_type"] == "JSONDecodeError"
    assert rows[3]["raw_payload"] == "�{"


def write_lines(folder, name, documents):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w") as out:
        out.writelines(d + "\n" for d in documents)


def lines_dataset():
    return Dataset("settlements", "lines", SETTLEMENT_EVENT)


def numbered(n):
    return json.dumps({**GOOD_LINE, "event_id": f"e{n}", "settlement_id": f"s{n}"})


def test_drain_writes_raw_quarantine_and_commit(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [numbered(1), numbered(2), "{broken"])
    write_lines(tmp_path / "in", "b.json", [numbered(3)])
    out, checkpoint = str(tmp_path / "raw"), str(tmp_path / "ck")

    def source():
        return file_messages(spark, str(tmp_path / "in"), "lines", max_files_per_trigger=1)

    stats = drain(source(), [lines_dataset()], out, checkpoint, STAMP)["settlements"]
    assert {k: stats[k] for k in ("consumed", "written", "malformed", "batches")} == {
        "consumed": 4,
        "written": 3,
        "malformed": 1,
        "batches": 2,
    }
    assert stats["files"] == len(list((tmp_path / "raw" / "settlements").rglob("*.parquet")))
    assert stats["quarantine_files"] == len(list((tmp_path / "raw" / "quarantine").rglob("*.parquet")))
    raw = read_raw(spark, out, "settlements")
    assert raw.columns == SETTLEMENT_EVENT.names
    assert raw.count() == 3
    assert {r[0] for r in raw.select(F.unix_timestamp("ingested_at")).distinct().collect()} == {
        int(STAMP.timestamp())
    }
    assert spark.read.parquet(f"{out}/quarantine/settlements").count() == 1
    assert list((tmp_path / "raw" / "settlements").rglob("ingest_date=2024-01-15/*.zstd.parquet"))
    assert commits(spark, out).agg(F.sum("written")).first()[0] == 3

    # nothing new: nothing is read, nothing is written
    again = drain(source(), [lines_dataset()], out, checkpoint, STAMP)["settlements"]
    assert again["consumed"] == 0
    # new data only
    write_lines(tmp_path / "in", "c.json", [numbered(4)])
    more = drain(source(), [lines_dataset()], out, checkpoint, STAMP)["settlements"]
    assert more["written"] == 1
    # a new checkpoint replays from the start, and the raw layer keeps the duplicates
    replay = drain(source(), [lines_dataset()], out, str(tmp_path / "ck2"), STAMP)["settlements"]
    assert replay["written"] == 4
    assert read_raw(spark, out, "settlements").count() == 8


def test_crash_before_the_commit_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    from tallymark.streaming import drain as module

    write_lines(tmp_path / "in", "a.json", [numbered(1), numbered(2), "{broken"])
    out, checkpoint = str(tmp_path / "raw"), str(tmp_path / "ck")
    source = file_messages(spark, str(tmp_path / "in"), "lines")
    real = module._write

    def failing(df, path):
        rows = real(df, path)
        if "quarantine" in path:
            raise OSError("store went away")
        return rows

    monkeypatch.setattr(module, "_write", failing)
    with pytest.raises(Exception, match="store went away"):
        drain(source, [lines_dataset()], out, checkpoint, STAMP)
    written = spark.read.schema(nullable(SETTLEMENT_EVENT)).parquet(f"{out}/settlements")
    assert written.count() == 2
    assert read_raw(spark, out, "settlements").count() == 0  # not committed

    monkeypatch.setattr(module, "_write", real)
    later = datetime(2024, 1, 16, 6, tzinfo=UTC)
    stats = drain(source, [lines_dataset()], out, checkpoint, later)["settlements"]
    assert stats["written"] == 2
    assert read_raw(spark, out, "settlements").count() == 2


def test_two_topics_in_one_stream_commit_together(spark, tmp_path):
    charge = {
        "event_id": "c1",
        "event_ts": "2024-01-01T00:00:00Z",
        "transaction_ref": "t1",
        "merchant_id": "m",
        "customer_id": "c",
        "gateway": "gateway_a",
        "channel": "card",
        "status": "success",
        "amount_kobo": 100,
        "fee_kobo": 1,
        "currency": "NGN",
        "settlement_lag_days": 1,
        "settlement_source_watermark_at": "2024-01-01T00:00:00Z",
        "created_at": "2024-01-01T00:00:00Z",
        "updated_at": "2024-01-01T00:00:00Z",
    }
    write_lines(tmp_path / "tx", "a.json", [json.dumps(charge)])
    write_lines(tmp_path / "stl", "a.json", [numbered(1)])
    both = file_messages(spark, str(tmp_path / "tx"), "charges").unionByName(
        file_messages(spark, str(tmp_path / "stl"), "lines")
    )
    datasets = [Dataset("transactions", "charges", TRANSACTION_EVENT), lines_dataset()]
    out = str(tmp_path / "raw")
    stats = ingest([(both, datasets, str(tmp_path / "ck"))], out, STAMP)
    assert stats["transactions"]["written"] == stats["settlements"]["written"] == 1
    assert commits(spark, out).select("batch").distinct().count() == 1
    with pytest.raises(RuntimeError, match="ingest wrote 0 rows"):
        ingest([(both, datasets, str(tmp_path / "ck"))], out, STAMP)


def test_raw_must_exist(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path), "transactions")
