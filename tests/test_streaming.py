from __future__ import annotations

import gzip
import json
import os
import shutil
import time
import zlib

import pytest
from helpers import at, money, rows
from pyspark.errors import StreamingQueryException

from ordermill.plans import pipeline
from ordermill.streaming import enrich, ingest, unzip


def _event(order, **changes):
    event = {
        "order_id": order, "customer_state": "SP", "product": "laptop", "price": 10.5, "freight_value": 1.25,
        "total_amount": 11.75, "payment_type": "boleto", "order_status": "shipped", "review_score": 4,
        "created_at": "2024-03-01T10:00:00Z",
    }
    return json.dumps({**event, **changes})


def _run(spark, tmp_path, **options):
    return ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ledger"), **options)


def _good(spark, tmp_path):
    return ingest.stream_table(spark, str(tmp_path / "out"))


def test_files_lines_and_reruns(spark, tmp_path):
    inbox = tmp_path / "in"
    (inbox / "sub").mkdir(parents=True)
    (inbox / "a.json").write_text(_event("1") + "\n\n  \n" + "{broken\n" + _event("2", price="many") + "\n")
    (inbox / "sub" / "b.gz").write_bytes(gzip.compress((_event("3", extra=1) + "\n").encode()))
    (inbox / "c.txt").write_text(_event("4") + "\n")
    _run(spark, tmp_path)
    good = _good(spark, tmp_path)
    assert rows(good, "order_id", "event_timestamp") == [("1", at("2024-03-01T10:00")), ("3", at("2024-03-01T10:00"))]
    assert good.where("loaded_at IS NULL").count() == 0
    bad = rows(ingest.quarantine(spark, str(tmp_path / "out")), "line")
    assert [b[0][:8] for b in bad] == ['{"order_', "{broken"]

    _run(spark, tmp_path)
    assert _good(spark, tmp_path).count() == 2
    (inbox / "d.json").write_text(_event("5", event_timestamp="2024-04-01 00:00:00") + "\n")
    _run(spark, tmp_path)
    again = _good(spark, tmp_path)
    assert rows(again, "order_id") == [("1",), ("3",), ("5",)]
    assert rows(again.where("order_id = '5'"), "event_timestamp") == [(at("2024-04-01T00:00"),)]


def test_times_that_do_not_parse_cost_their_row_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [
        _event("1"), _event("2", created_at="yesterday"), _event("3", event_timestamp="soon"),
        _event("4", event_timestamp="2024-04-01T00:00:00Z"), _event("5", event_timestamp="2024-04-01T00:00:00+02:00"),
        _event("6", created_at=None),
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    assert _run(spark, tmp_path) == []
    assert rows(_good(spark, tmp_path), "order_id", "event_timestamp") == [
        ("1", at("2024-03-01T10:00")), ("4", at("2024-04-01T00:00")), ("5", at("2024-03-31T22:00")), ("6", None)
    ]
    bad = [json.loads(r.line) for r in ingest.quarantine(spark, str(tmp_path / "out")).collect()]
    assert sorted((b["order_id"], b.get("created_at"), b.get("event_timestamp")) for b in bad) == [
        ("2", "yesterday", None), ("3", "2024-03-01T10:00:00Z", "soon")
    ]


def test_a_cut_off_file_is_left_out_recorded_and_tried_again(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    whole = gzip.compress("".join(_event(str(i)) + "\n" for i in range(3000)).encode())
    (inbox / "b.gz").write_bytes(whole[: len(whole) // 2])
    for name in ("a", "c", "d"):
        (inbox / f"{name}.json").write_text(_event(name) + "\n")
    failed = _run(spark, tmp_path)
    assert [os.path.basename(f) for f, _ in failed] == ["b.gz"] and failed[0][1]
    assert rows(_good(spark, tmp_path), "order_id") == [("a",), ("c",), ("d",)]
    assert len(_run(spark, tmp_path)) == 1
    (inbox / "b.gz").write_bytes(whole)
    assert _run(spark, tmp_path) == []
    assert _good(spark, tmp_path).count() == 3003
    assert ingest.failures(spark, str(tmp_path / "out")).count() == 2
    assert ingest.outstanding(spark, str(tmp_path / "out")).count() == 0
    _run(spark, tmp_path)
    assert _good(spark, tmp_path).count() == 3003


def test_a_failed_file_may_have_any_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "a{1} [x].gz"
    whole = gzip.compress((_event("1") + "\n").encode())
    path.write_bytes(whole[:-4])
    assert len(_run(spark, tmp_path)) == 1
    path.write_bytes(whole)
    assert _run(spark, tmp_path) == [] and _good(spark, tmp_path).count() == 1


def test_attempts_are_counted_and_a_failed_file_may_vanish(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gz").write_bytes(b"no zip")
    for attempt in (1, 2, 3):
        _run(spark, tmp_path)
        row = ingest.outstanding(spark, str(tmp_path / "out")).first()
        assert row.attempts == attempt and "error" in row.error
    (tmp_path / "in" / "a.gz").unlink()
    assert len(_run(spark, tmp_path)) == 1 and _good(spark, tmp_path).count() == 0


def test_old_files_count_and_batches_are_bounded(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        path = tmp_path / "in" / f"{i}.json"
        path.write_text(_event(str(i)) + "\n")
        os.utime(path, (time.time() - i * 30 * 86400,) * 2)
        _run(spark, tmp_path)
    assert _good(spark, tmp_path).count() == 3
    other = tmp_path / "small"
    ingest.ingest(spark, str(tmp_path / "in"), str(other), str(tmp_path / "ledger2"), max_bytes=1)
    assert len(ingest.batches(spark, str(other))) == 3 and ingest.stream_table(spark, str(other)).count() == 3


def test_the_file_stream_fills_the_same_sink(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2):
        path = tmp_path / "in" / f"{i}.json"
        path.write_text(_event(str(i)) + "\n" + _event("x", created_at="never") + "\n")
        os.utime(path, (time.time() - 40 * 86400 * i,) * 2)
        ingest.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "points")).awaitTermination()
    assert rows(_good(spark, tmp_path), "order_id") == [("0",), ("1",)]
    assert ingest.quarantine(spark, str(tmp_path / "out")).count() == 2


class Crash(Exception):
    pass


def _crashing(monkeypatch, owner, name, after: bool, times: int = 1):
    """Lets the next calls fail, before or after they do their work."""
    real, left = getattr(owner, name), [times]

    def call(*args, **kwargs):
        if not left[0]:
            return real(*args, **kwargs)
        left[0] -= 1
        if after:
            real(*args, **kwargs)
        raise Crash("the driver is gone")

    monkeypatch.setattr(owner, name, call)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("name", ["_store", "_try_again", "outstanding"])
def test_each_event_once_whatever_write_a_crash_follows(spark, tmp_path, monkeypatch, name, after):
    inbox = tmp_path / "in"
    inbox.mkdir()
    whole = gzip.compress("".join(_event(f"z{i}") + "\n" for i in range(500)).encode())
    (inbox / "z.gz").write_bytes(whole[:-20])
    (inbox / "a.json").write_text(_event("a") + "\n")
    _run(spark, tmp_path)
    (inbox / "z.gz").write_bytes(whole)
    (inbox / "b.json").write_text(_event("b") + "\n")
    with monkeypatch.context() as broken:
        _crashing(broken, ingest, name, after)
        with pytest.raises((Crash, StreamingQueryException)):
            _run(spark, tmp_path)
    assert _run(spark, tmp_path) == []
    ids = [r.order_id for r in _good(spark, tmp_path).collect()]
    assert sorted(ids) == sorted(["a", "b", *(f"z{i}" for i in range(500))])


def test_a_sink_error_ends_the_run_and_blames_no_file(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(_event("1") + "\n")
    with monkeypatch.context() as broken:
        _crashing(broken, ingest, "_store", after=False)
        with pytest.raises(StreamingQueryException):
            _run(spark, tmp_path)
    assert ingest.failures(spark, str(tmp_path / "out")).count() == 0
    assert _run(spark, tmp_path) == [] and _good(spark, tmp_path).count() == 1


def test_a_folder_that_was_not_completed_does_not_count(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.json").write_text(_event("1") + "\n")
    _run(spark, tmp_path)
    half = tmp_path / "out" / "batch_id=stream-000000001"
    shutil.copytree(tmp_path / "out" / "batch_id=stream-000000000", half)
    (half / "_SUCCESS").unlink()
    assert _good(spark, tmp_path).count() == 1
    (inbox / "b.json").write_text(_event("2") + "\n")
    _run(spark, tmp_path)
    assert rows(_good(spark, tmp_path), "order_id") == [("1",), ("2",)]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("name", ["_write_batches", "_enter_batches"])
def test_the_stream_table_has_each_event_once_after_a_crash(spark, layer, tmp_path, monkeypatch, name, after):
    inbox = tmp_path / "in"
    inbox.mkdir()
    args = (str(inbox), str(tmp_path / "out"), str(tmp_path / "points"), layer)
    for i in range(3):
        (inbox / f"{i}.json").write_text(_event(str(i)) + "\n")
        if i == 1:
            with monkeypatch.context() as broken:
                _crashing(broken, pipeline, name, after)
                with pytest.raises(Crash):
                    pipeline.load_stream(spark, *args)
        else:
            pipeline.load_stream(spark, *args)
    table = spark.table(f"{layer}.streaming_orders")
    assert rows(table, "order_id") == [("0",), ("1",), ("2",)] and table.where("loaded_at IS NULL").count() == 0
    (inbox / "blank.json").write_text("\n")
    for _ in range(2):
        pipeline.load_stream(spark, *args)
    assert spark.sql(f"SHOW PARTITIONS {layer}.streaming_orders").count() == 4 and table.count() == 3


def test_state_and_day_prune_the_scan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(_event("1") + "\n")
    _run(spark, tmp_path)
    plan = _good(spark, tmp_path).where("event_date = date'2024-03-01'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(record_state" in text and plan.count() == 1


def test_only_new_batches_are_enriched(spark, tmp_path):
    gold = spark.createDataFrame(
        [("1", "SP", "books", money("5.00")), ("1", "SP", "toys", money("6.00")), ("2", "RJ", "books", money("7.00"))],
        "order_id STRING, customer_state STRING, product_category_name STRING, total_order_amount DECIMAL(18,2)",
    )
    (tmp_path / "in").mkdir()
    events, target = str(tmp_path / "out"), str(tmp_path / "enriched")
    assert enrich.enriched(spark, target, gold).count() == 0
    for i, expected in ((1, 2), (2, 3), (3, 3)):
        (tmp_path / "in" / f"{i}.json").write_text(_event(str(i)) + "\n")
        _run(spark, tmp_path)
        assert enrich.enrich_new(spark, events, gold, target) == 1
        assert enrich.enriched(spark, target, gold).count() == expected
    assert enrich.enrich_new(spark, events, gold, target) == 0
    assert enrich.enriched(spark, target, gold).columns == [
        "order_id", "customer_state", "product_category_name", "total_order_amount", "status_on_s3",
        "streaming_review_score", "streaming_arrival_time",
    ]


def test_an_unfinished_enrichment_is_written_over(spark, tmp_path):
    gold = spark.createDataFrame(
        [("1", "SP", "books", money("5.00"))],
        "order_id STRING, customer_state STRING, product_category_name STRING, total_order_amount DECIMAL(18,2)",
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(_event("1") + "\n")
    _run(spark, tmp_path)
    target = tmp_path / "enriched"
    enrich.enrich_new(spark, str(tmp_path / "out"), gold, str(target))
    (target / "run=000000000" / "_SUCCESS").unlink()
    assert enrich.enriched(spark, str(target), gold).count() == 0
    assert enrich.enrich_new(spark, str(tmp_path / "out"), gold, str(target)) == 1
    assert enrich.enriched(spark, str(target), gold).count() == 1


def test_the_stored_gold_table_is_not_moved(spark, layer):
    """Beyond the broadcast limit, only the events are shuffled: the gold side has no exchange."""
    gold = spark.createDataFrame(
        [(str(i), "SP", "books", money("5.00")) for i in range(20)],
        "order_id STRING, customer_state STRING, product_category_name STRING, total_order_amount DECIMAL(18,2)",
    )
    stored = enrich.store_gold(gold, f"{layer}.gold", 8)
    events = spark.createDataFrame(
        [("1", "shipped", 4, "2024-03-01T10:00:00Z", None)],
        "order_id STRING, order_status STRING, review_score INT, created_at STRING, event_date DATE",
    )
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        both = enrich.joined(stored, events)
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert both.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1


LINES = ["one", "", "two words", "ü", "x" * 70_000, "last"]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_unzipped_lines(monkeypatch, end, piece):
    monkeypatch.setattr(unzip, "PIECE", piece)
    text = end.join(LINES).encode()
    one, two = text[: len(text) // 2], text[len(text) // 2 :]
    for content in (gzip.compress(text), gzip.compress(one) + gzip.compress(two), gzip.compress(text + end.encode())):
        assert list(unzip.unzipped_lines(content)) == LINES
    assert list(unzip.unzipped_lines(b"")) == []
    whole = gzip.compress(text)
    for size in (1, 9, len(whole) // 2, len(whole) - 1):
        with pytest.raises((EOFError, zlib.error)):
            list(unzip.unzipped_lines(whole[:size]))
    damaged = bytearray(whole)
    damaged[-6] ^= 1
    with pytest.raises(zlib.error):
        list(unzip.unzipped_lines(bytes(damaged)))
