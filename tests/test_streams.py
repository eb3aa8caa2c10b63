"""Streams that are run again on their root, and the keyed log behind them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import SF_SMALL, rows

from sluice.operators import rules as RL
from sluice.operators import usage as U
from sluice.sources.tables import payload_log
from sluice.streaming import streams as S
from sluice.streaming.keyed_log import KeyedLog

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def as_folder(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(f"{folder}/events.parquet")
    return folder


def arrivals(spark, tmp_path, *batches, schema=EVENTS):
    """Yields the payload stream and the batch payload after each arrival."""
    folder = str(tmp_path / "events")
    for batch in batches:
        df = spark.createDataFrame(batch, schema) if isinstance(batch, list) else batch
        df.coalesce(1).write.mode("append").parquet(folder)
        yield payload_log(spark.readStream.schema(df.schema).parquet(folder)), payload_log(spark.read.parquet(folder))


def usage(payload):
    return payload.groupBy(F.col("request_time").cast("date").alias("day")).agg(*U.usage_measures()).select(*U.usage_columns(F.col("day")))


def test_one_run_gives_the_whole_report(spark, tmp_path):
    folder = as_folder(spark, tmp_path)
    payload = payload_log(spark.read.parquet(f"{folder}/events.parquet"))
    stream = lambda: payload_log(S.stream_table(spark, folder, "events"))
    assert rows(S.drain(stream(), S.usage_daily_stream, ["day"], "t_usage")) == rows(usage(payload))
    breaches = S.drain(stream(), lambda p: S.rate_limit_stream(p, 2, 1), S.RATE_KEYS, "t_rates")
    assert rows(breaches) == rows(U.rate_limit_breaches(payload, 2, 1)) and breaches.count() > 0
    assert rows(S.append_payload(stream())) == rows(payload)


def test_later_runs_amend_the_open_windows(spark, tmp_path):
    """Two runs of one root give the batch report each, whatever window the first one was cut in."""
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    cut = events.agg(F.max("event_id") / 2).first()[0]
    root = {n: str(tmp_path / n) for n in ("usage", "rates")}
    for stream, batch in arrivals(spark, tmp_path, events.where(F.col("event_id") < cut), events.where(F.col("event_id") >= cut)):
        assert rows(S.drain(stream, S.usage_daily_stream, ["day"], "u", root=root["usage"])) == rows(usage(batch))
        got = S.drain(stream, lambda p: S.rate_limit_stream(p, 2, 1), S.RATE_KEYS, "r", root=root["rates"])
        assert rows(got) == rows(U.rate_limit_breaches(batch, 2, 1))
    # a run without new files changes nothing
    assert rows(S.drain(stream, S.usage_daily_stream, ["day"], "u", root=root["usage"])) == rows(usage(batch))


def test_a_report_of_days_that_follow_each_other(spark, tmp_path):
    t = dt.datetime
    first = [(i, t(2024, 1, 1, i), 1, "view", 1.0, "x") for i in range(5)]
    second = [(10 + i, t(2024, 1, 3, i), 2, "view", 2.0, "yy") for i in range(7)]
    root = str(tmp_path / "root")
    reports = [rows(S.drain(s, S.usage_daily_stream, ["day"], "u", root=root), "day", "pr_reviews") for s, _ in arrivals(spark, tmp_path, first, second)]
    assert reports == [[(dt.date(2024, 1, 1), 5)], [(dt.date(2024, 1, 1), 5), (dt.date(2024, 1, 3), 7)]]


def test_real_limits_count_on_in_an_open_minute(spark, tmp_path):
    t = dt.datetime
    call = lambda i, user: (i, t(2024, 1, 1, 0, 0, i % 60), user, "view", 1.0, "x")
    first, second = [call(i, i % 3) for i in range(50)], [call(i, i % 3) for i in range(50, 64)]
    root = str(tmp_path / "root")
    got = [rows(S.drain(s, S.rate_limit_stream, S.RATE_KEYS, "r", root=root), "key", "calls", "limit_per_minute") for s, _ in arrivals(spark, tmp_path, first, second)]
    assert got == [[], [("u0", 22, 20), ("u1", 21, 20), ("u2", 21, 20), ("view", 64, 60)]]


def test_late_rows_are_not_counted(spark, tmp_path):
    t = dt.datetime
    first = [(1, t(2024, 1, 1, 0, 0, 10), 1, "view", 1.0, "x"), (2, t(2024, 1, 1, 0, 0, 20), 1, "view", 1.0, "x"), (3, t(2024, 1, 1, 0, 10, 0), 2, "view", 1.0, "x")]
    late = [(4, t(2024, 1, 1, 0, 0, 30), 1, "view", 1.0, "x"),  # older than the watermark
            (5, t(2024, 1, 1, 0, 20, 0), 2, "view", 1.0, "x")]
    root = str(tmp_path / "root")
    for stream, _ in arrivals(spark, tmp_path, first, late):
        out = S.drain(stream, lambda p: S.rate_limit_stream(p, 10, 1), S.RATE_KEYS, "r", root=root)
    assert rows(out, "key", "minute", "calls") == [("u1", t(2024, 1, 1, 0, 0), 2)]


def test_an_empty_stream_gives_an_empty_frame(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(f"{folder}/events.parquet")
    out = S.drain(payload_log(S.stream_table(spark, folder, "events")), S.usage_daily_stream, ["day"], "t_none")
    assert out.columns == ["day", "pr_reviews", "avg_secs", "est_tokens"] and out.count() == 0


def test_a_request_is_appended_once(spark, tmp_path):
    t = dt.datetime
    row = lambda i, day=1: (i, t(2024, 1, day), 1, "view", 1.0, "x")
    first = [row(1), row(2), row(2), row(None), row(None)]
    second = [row(2), row(3, 9), row(None), row(None, 2)]
    third = first + [row(4, 1)]  # delivered again long after, and a late row
    root = str(tmp_path / "root")
    counts = []
    for stream, batch in arrivals(spark, tmp_path, first, second, third):
        log = S.append_payload(stream, root=root)
        assert rows(log) == rows(batch.distinct())
        counts.append(log.count())
    assert counts == [3, 5, 6]


LOG = "k long, op string, v string, at long"


def log_of(spark, tmp_path, **kw):
    return KeyedLog(spark, str(tmp_path / "log"), ["k"], "at", spark.createDataFrame([], LOG).schema, **kw)


def test_fifty_batches_stay_cheap_to_look_up(spark, tmp_path, rng=None):
    """The state equals a rebuild; files and rows that a batch of new keys opens do not grow with the batches."""
    import random
    rng = random.Random(5)
    log, want, opened = log_of(spark, tmp_path, rows_per_file=20), {}, []
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    for epoch in range(50):
        batch = {epoch * 10 + i: ("insert", f"new {epoch}") for i in range(10)}
        if epoch % 5 == 4:
            batch[rng.randrange(epoch * 10)] = ("update", f"changed {epoch}")
            batch[rng.randrange(epoch * 10)] = ("delete", None)
        frame = spark.createDataFrame([(k, op, v, k) for k, (op, v) in batch.items()], LOG)
        if epoch % 10 == 9:
            held = log.holding(frame)
            opened.append((len(held), sum(f.rows for f in held)))
        log.append(frame, epoch)
        want.update(batch)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted((r.k, r.v) for r in log.state().collect()) == sorted((k, v) for k, (op, v) in want.items() if op != "delete")
    files = log.files()
    assert len({(f.level, f.epoch) for f in files}) <= 10 and sum(f.rows for f in files) < 520  # few runs, versions merged away
    assert max(n for n, _ in opened) <= 12 and max(r for _, r in opened) <= 240
    assert opened[-1][1] < sum(f.rows for f in files) / 3
    kept = log.state().count()
    assert log.vacuum() > 0 and log.state().count() == kept


def test_a_repeated_epoch_and_a_failed_attempt_change_nothing(spark, tmp_path):
    log = log_of(spark, tmp_path, fanout=2)
    frame = lambda v: spark.createDataFrame([(1, "insert", v, 1)], LOG)
    assert log.append(frame("a"), 0) and not log.append(frame("b"), 0)
    log._write(frame("lost").withColumn("epoch", F.lit(1).cast("bigint")), 0, 1)  # an attempt that ended before its manifest
    assert [r.v for r in log.state().collect()] == ["a"]
    assert log.append(spark.createDataFrame([(1, "delete", None, 1)], LOG), 1)
    assert log.state().count() == 0 and log.rows().count() == 0  # merged at the last level: nothing is left to hide
    assert [r.v for r in log.state(before=1).collect()] == ["a"]
    assert log.append(spark.createDataFrame([], LOG), 2) and log.state().count() == 0


@pytest.mark.parametrize("asked,held", [([], 0), ([5], 1), ([1000], 0), ([-4, 29], 1), ([9, 10], 2), (list(range(30)), 3)])
def test_only_files_that_can_hold_a_key_are_opened(spark, tmp_path, asked, held):
    log = log_of(spark, tmp_path, rows_per_file=10)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    log.append(spark.createDataFrame([(k, "insert", "v", k) for k in range(30)], LOG), 0)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(log.holding(spark.createDataFrame([(a,) for a in asked], "at long"))) == held
    got = log.state(of=spark.createDataFrame([(a,) for a in asked], "at long"))
    assert sorted(r.k for r in got.collect()) == sorted(set(asked) & set(range(30)))


def test_index_sync_two_epochs(spark, tmp_path):
    schema = "doc_id long, category string, block string"
    folder, root = str(tmp_path / "docs"), str(tmp_path / "sync")
    first = [(1, "env", "### [ENV-01] Cross env\nbody one\n### [ENV-02] Second\nsame"), (2, "tp", "### [TP-02] Driver actions\nbody two")]
    second = [(1, "env", "### [ENV-01] Cross env\nbody one, revised"), (4, "nm", "### [NM-01] Snake case\nbody"), (2, "tp", "### [TP-02] Driver actions\nbody two")]
    sch = spark.createDataFrame([], schema).schema

    def run(docs):
        spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(folder)
        return S.run_index_sync(spark.readStream.schema(sch).parquet(folder), root=root)

    run(first)
    log = run(second)
    assert rows(log, "epoch", "rule_id", "op") == [(0, "ENV-01", "insert"), (0, "ENV-02", "insert"), (0, "TP-02", "insert"),
                                                   (1, "ENV-01", "update"), (1, "ENV-02", "delete"), (1, "NM-01", "insert")]
    state = S.index_state(spark, f"{root}/index")
    assert rows(state, "rule_id") == [("ENV-01",), ("NM-01",), ("TP-02",)]
    assert [r.content for r in state.where("rule_id = 'ENV-01'").collect()] == ["Cross env\n\nbody one, revised"]


def test_index_after_many_arrivals_equals_a_rebuild(spark, tmp_path):
    schema = "doc_id long, category string, block string"
    folder, root, last = str(tmp_path / "docs"), str(tmp_path / "sync"), {}
    sch = spark.createDataFrame([], schema).schema
    for turn in range(7):
        docs = [(d, "c", f"### [AB-{d}] Title\nbody {d % 3 if d % 2 else turn}\n" + (f"### [CD-{d}] More\nx" if (d + turn) % 3 else "")) for d in range(turn, turn * 3 + 3)]
        last.update({d[0]: d for d in docs})
        spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(folder)
        S.run_index_sync(spark.readStream.schema(sch).parquet(folder), root=root)
    rebuilt = RL.parse_rules(spark.createDataFrame(list(last.values()), schema)).select("doc_id", *S.RULE_COLUMNS)
    assert rows(S.index_state(spark, f"{root}/index")) == rows(rebuilt)
