import datetime as dt
import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import staging as st
from tidemark.session import checkpoint_root, fresh_dir, settings
from tidemark.sources import files, kafka, widerow
from tidemark.streaming import ingest, live

AT = "2024-01-0{}T10:00:00+00:00"


def record(**changes):
    base = {
        "product_id": "p1", "source": "jumia.ma", "url": "https://x/1", "title": "T", "price": 10.0, "currency": "MAD",
        "rating": None, "availability": None, "category": None, "image_url": None, "scraped_at": AT.format(1),
    }
    return {k: v for k, v in {**base, **changes}.items() if v != "drop"}


def lines(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records)
    (folder / name).write_text(text + "\n")


def test_read_observations(spark, tmp_path):
    lines(tmp_path / "a", "x.jsonl", record(extra=1), '{"product_id": "cut', record(price="not-a-number"))
    lines(tmp_path / "b" / "c", "y.jsonl", record(product_id="p2", url="drop"))
    good, bad = files.split_corrupt(files.read_observations(spark, str(tmp_path)))
    assert {r.product_id for r in good.collect()} == {"p1", "p2"} and good.count() == 3
    assert bad.count() == 1 and good.where("price IS NULL").count() == 1
    first = good.where("product_id = 'p1'").select(F.col("scraped_at").cast("timestamp_ntz")).first()[0]
    assert first == dt.datetime(2024, 1, 1, 10)


def test_load_raw_is_repeatable(spark, tmp_path):
    rows = files.parse_records(spark.createDataFrame([(json.dumps(record(scraped_at=AT.format(d))),) for d in (1, 1, 2)], "value string"))
    rows = rows.drop("value", files.CORRUPT)
    path = str(tmp_path / "raw")
    files.load_raw(rows, path)
    files.load_raw(rows.unionByName(rows.withColumn("product_id", F.lit("new"))), path)
    table = spark.read.parquet(path)
    assert table.count() == 4 and table.select("scraped_date").distinct().count() == 2


def test_jsonl_and_reports(spark, tmp_path):
    rows = files.parse_records(spark.createDataFrame([(json.dumps(record()),)], "value string")).drop("value", files.CORRUPT)
    files.write_jsonl(rows, str(tmp_path / "out"))
    back = files.split_corrupt(files.read_observations(spark, str(tmp_path / "out")))[0]
    assert back.first().source == "jumia.ma" and (tmp_path / "out" / "spider=jumia.ma").exists()
    files.write_stat_tables({"one": rows.select("price")}, str(tmp_path / "stats"), "2024-01-01")
    assert files.read_mart(spark, str(tmp_path / "stats" / "one")).first().run_date == dt.date(2024, 1, 1)


def test_priority_and_guards(spark):
    full, empty = spark.range(3), spark.range(0)
    assert files.first_available([lambda: spark.table("nope"), lambda: empty, lambda: full]).count() == 3
    with pytest.raises(LookupError):
        files.first_available([lambda: empty])
    with pytest.raises(ValueError):
        files.assert_non_empty(empty)
    assert files.materialize(full, "a_view", "view").count() == 3
    assert files.materialize(full, "x", "inline") is full
    with pytest.raises(ValueError):
        files.materialize(full, "x", "other")


def test_topic_messages(spark):
    rows = spark.createDataFrame([("p1", "T", "a"), ("", "T2", "a"), (None, None, "b")], "product_id string, title string, source string")
    got = kafka.to_messages(rows).collect()
    assert [r.key for r in got] == ["p1", "T2", None]
    assert json.loads(got[0].value) == {"product_id": "p1", "source": "a", "title": "T"}
    assert kafka.to_messages(rows, "b").count() == 1


def observations(spark, *rows):
    df = files.parse_records(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
    return df.drop("value", files.CORRUPT)


def test_wide_rows(spark, tmp_path):
    path = str(tmp_path / "wide")
    rows = observations(spark, record(), record(scraped_at=AT.format(2), price=8.5, rating=4.0), record(product_id="p10"), record(product_id=""))
    widerow.upsert_wide_row(rows, path, F.lit("2024-02-01").cast("timestamp"), 4)
    widerow.upsert_wide_row(observations(spark, record(price=11.0)), path, F.lit("2024-02-02").cast("timestamp"), 4)
    table = widerow.read_rows(spark, path)
    assert [r.price for r in widerow.product_history(table, "p1", buckets=4).collect()] == [8.5, 11.0]
    assert widerow.product_history(table, "p1", 1, 4).count() == 1
    latest = widerow.latest_price(table, "p1", 4).first()
    assert (latest.price, latest.rating, latest.category) == (8.5, 4.0, "")
    assert widerow.latest_price(table, "none", 4).isEmpty()
    assert widerow.scan_all(table, 2).count() == 2
    widerow.compact(table, str(tmp_path / "compact"))
    assert widerow.read_rows(spark, str(tmp_path / "compact")).count() == 3 and table.count() == 4
    assert widerow.writable(rows)[1].count() == 1


def test_point_read_is_pruned(spark, tmp_path):
    path = str(tmp_path / "wide")
    widerow.upsert_wide_row(observations(spark, record(), record(product_id="p2")), path, buckets=4)
    plan = widerow.product_rows(widerow.read_rows(spark, path), "p1", 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan and "GreaterThanOrEqual(row_key,p1#)" in plan


def test_wide_table_ddl(spark, tmp_path):
    name = "wide_ddl_test"
    location = str(tmp_path / "t")
    widerow.create_table(spark, name, location)
    widerow.create_table(spark, name, location)
    assert spark.table(name).isEmpty()
    widerow.drop_table(spark, name)
    widerow.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_shared_folder_comes_from_the_session(spark):
    assert fresh_dir(spark, "x").startswith(checkpoint_root(spark))


def test_stream_of_micro_batches(spark, tmp_path):
    lines(tmp_path / "in", "1.jsonl", record(), record(), '{"product_id": "cut', record(extra="x", product_id="p2"))
    lines(tmp_path / "in", "2.jsonl", record(), record(price=-1.0), record(product_id="p3", scraped_at="drop"), record(title=""))
    out, calls = tmp_path / "out", []

    def failing(batch, batch_id):
        calls.append(batch_id)
        raise OSError("down")

    sinks = [
        ingest.Sink("failing", failing),
        ingest.Sink("never", failing, enabled=False),
        ingest.folder_sink("valid", str(out / "valid")),
    ]
    texts = ingest.text_stream(spark, str(tmp_path / "in"), max_files=1)
    ingest.wait(*ingest.ingest_stream(texts, sinks, ingest.folder_sink("r", str(out / "rejects")), str(out / "cp")))
    valid = spark.read.parquet(str(out / "valid"))
    assert sorted(r.product_id for r in valid.collect()) == ["p1", "p2", "p3"] and calls
    assert valid.where("product_id = 'p3' and scraped_at is not null and availability = 'Unknown' and pipeline = 'nifi-streaming'").count() == 1
    reasons = sorted(r.reject_reason for r in spark.read.parquet(str(out / "rejects")).collect())
    assert reasons == ["corrupt record", "missing title", "negative price"]
    # A second run over the same files has nothing left to do; the sink that was down gets what it missed.
    again = ingest.start_valid(ingest.valid_records(ingest.observed(ingest.prepare(texts))), sinks, str(out / "cp" / "valid"))
    ingest.wait(again)
    assert spark.read.parquet(str(out / "valid")).count() == 3
    up = ingest.folder_sink("failing", str(out / "late"))
    assert len(ingest.retry_failed(spark, up, str(out / "cp/valid/failed"))) == len(calls)
    assert spark.read.parquet(str(out / "late")).count() == 3
    assert ingest.read_counters(spark, str(out / "cp" / "valid")).first() == (5, 3, 2)


def test_no_record_is_lost_for_its_time(spark, tmp_path):
    """Batches in any order of time, one record without a time, one from another source at the same time."""
    days = [5, 1, 2, 6, 1]
    for i, day in enumerate(days):
        lines(tmp_path / "in", f"{i}.jsonl", record(product_id=f"d{day}", scraped_at=AT.format(day)))
    lines(tmp_path / "in", "7.jsonl", record(product_id="none", scraped_at="drop"))
    lines(tmp_path / "in", "8.jsonl", record(product_id="d2", scraped_at=AT.format(2), source="other"), record(product_id="old", price="17.5"))
    texts = ingest.text_stream(spark, str(tmp_path / "in"), max_files=1)
    sinks = [ingest.folder_sink("valid", str(tmp_path / "valid"))]
    ingest.wait(*ingest.ingest_stream(texts, sinks, ingest.folder_sink("r", str(tmp_path / "rejects")), str(tmp_path / "cp")))
    got = sorted(r.product_id for r in spark.read.parquet(str(tmp_path / "valid")).collect())
    assert got == ["d1", "d2", "d2", "d5", "d6", "none", "old"]
    assert ingest.read_counters(spark, str(tmp_path / "cp/valid")).first() == (8, 7, 1)


def test_replays_are_found_in_state_that_costs_the_batch_only(spark, tmp_path):
    """Fifty batches, every second one a replay of the first: no batch reads or copies more than the early ones."""
    for k in range(50):
        rows = [record(product_id=f"p{0 if k % 2 else k}-{j}") for j in range(20)]
        lines(tmp_path / "in", f"{k:02d}.jsonl", *rows)
        os.utime(tmp_path / "in" / f"{k:02d}.jsonl", (1_700_000_000 + k, 1_700_000_000 + k))
    texts = ingest.text_stream(spark, str(tmp_path / "in"), max_files=1)
    valid = ingest.valid_records(ingest.prepare(texts))
    query = ingest.start_valid(valid, [ingest.folder_sink("valid", str(tmp_path / "valid"))], str(tmp_path / "cp"))
    ingest.wait(query)
    assert spark.read.parquet(str(tmp_path / "valid")).count() == 500
    assert ingest.read_counters(spark, str(tmp_path / "cp")).first() == (1000, 500, 500)
    batches = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    assert len(batches) >= 50 and "rocksdbBytesCopied" in batches[0].customMetrics
    copied = [b.customMetrics["rocksdbBytesCopied"] for b in batches]
    assert sum(copied[25:50]) <= sum(copied[:25]) + 4096
    assert batches[-1].numRowsTotal == 500


def test_rejects_are_parsed_once(spark, tmp_path):
    """The rules see the parsed record, not one parse each; state has no more partitions than the cores can use."""
    lines(tmp_path / "in", "1.jsonl", record(), record(price=-1.0), record(price=" 7.5\u2028"), record(price="0x1p3"), '{"cut')
    refused = ingest.rejected_records(ingest.prepare(spark.read.text(str(tmp_path / "in"))))
    assert refused._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert sorted(r.reject_reason for r in refused.collect()) == ["corrupt record", "negative price", "price not numeric"]
    with settings(spark, {"spark.sql.shuffle.partitions": "5000"}):
        assert int(ingest.state_settings(spark)["spark.sql.shuffle.partitions"]) <= max(16, 2 * spark.sparkContext.defaultParallelism)


def test_counters(spark, tmp_path):
    lines(tmp_path / "in", "1.jsonl", record(), record(price=-1.0), record(product_id="p2"))
    counters = ingest.IngestCounters()
    spark.streams.addListener(counters)
    try:
        marked = ingest.observed(ingest.prepare(ingest.text_stream(spark, str(tmp_path / "in"))))
        query = ingest.start(marked, [ingest.folder_sink("all", str(tmp_path / "all"))], str(tmp_path / "cp"))
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert (counters.ingested, counters.errors) == (2, 1) and counters.rate > 0
    finally:
        spark.streams.removeListener(counters)


def test_live_current(spark, tmp_path):
    lines(tmp_path / "in", "1.jsonl", record(scraped_at=AT.format(2), price=5.0), record(product_id="p2"))
    texts = ingest.text_stream(spark, str(tmp_path / "in"), max_files=1)
    good = ingest.prepare(texts).where("reject_reason is null")
    log, cp = str(tmp_path / "log"), str(tmp_path / "cp")
    live.start_current(good, log, cp).awaitTermination()
    lines(tmp_path / "in", "2.jsonl", record(scraped_at=AT.format(1), price=9.0), record(product_id="p2", scraped_at=AT.format(3), price=7.0))
    live.start_current(good, log, cp).awaitTermination()
    assert {(r.product_id, r.price) for r in live.read_current(spark, log).collect()} == {("p1", 5.0), ("p2", 7.0)}


def test_rates(spark):
    rows = st.default_fields(spark.range(600).select(F.timestamp_seconds("id").alias("scraped_at"), F.col("id").cast("double").alias("price")), {"source": "a"})
    got = live.event_rates(rows, is_error=F.col("price") < 30).orderBy("window_start").collect()
    assert [(r.events, r.events_per_sec, r.error_ratio) for r in got] == [(300, 1.0, 0.1), (300, 1.0, 0.0)]
    assert (got[0].p50, got[0].p95) == (149.0, 284.0)


def test_load_raw_knows_whole_records(spark, tmp_path):
    """Another source or price at one time is another record; nulls are equal to nulls; three loads give equal rows."""
    records = [record(), record(source="other"), record(price=11.0), record(price="11"), record(scraped_at="drop"), record(scraped_at="drop"), record(title=None)]
    rows = files.parse_records(spark.createDataFrame([(json.dumps(r),) for r in records], "value string")).drop("value", files.CORRUPT)
    path = str(tmp_path / "raw")
    for _ in range(3):
        files.load_raw(rows, path)
        assert spark.read.parquet(path).count() == 5


def test_numbers_may_be_text(spark, tmp_path):
    lines(tmp_path, "a.jsonl", record(price="12.5", rating=" 3\n"), record(price="1d"), record(price=7), "\t\x0b ")
    good, bad = files.split_corrupt(files.read_observations(spark, str(tmp_path)))
    assert sorted((r.price or 0.0, r.rating or 0.0) for r in good.collect()) == [(0.0, 0.0), (7.0, 0.0), (12.5, 3.0)]
    assert bad.count() == 0


def test_intermediate_tables_need_a_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_equal_keys_have_one_winner(spark, tmp_path):
    """Of versions written together the same one wins in any order of the input."""
    rows = [record(price=5.0), record(price=9.0), record(price=9.0, category="b"), record(price=9.0, category="a")]
    for k, order in enumerate((rows, rows[::-1], rows[2:] + rows[:2])):
        df = files.parse_records(spark.createDataFrame([(json.dumps(r),) for r in order], "value string").repartition(k + 1)).drop("value", files.CORRUPT)
        path = str(tmp_path / f"w{k}")
        widerow.upsert_wide_row(df, path, F.lit("2024-01-01").cast("timestamp"), 4)
        got = widerow.decode_wide_row(widerow.read_rows(spark, path)).select("price", "category").collect()
        assert [tuple(r) for r in got] == [(9.0, "b")]


def test_scan_reads_only_the_first_keys(spark, tmp_path):
    path = str(tmp_path / "wide")
    for price in (1.0, 2.0, 3.0):
        rows = [record(product_id=f"p{i}", price=price) for i in range(9)]
        df = files.parse_records(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")).drop("value", files.CORRUPT)
        widerow.upsert_wide_row(df, path, F.lit(f"2024-01-0{int(price)}").cast("timestamp"), 4)
    rows = widerow.read_rows(spark, path)
    got = widerow.scan_all(rows, 4)
    assert [(r.row_key.split("#")[0], r.price) for r in got.collect()] == [(f"p{i}", 3.0) for i in range(4)]
    assert "LessThanOrEqual(row_key,p" in got._jdf.queryExecution().executedPlan().toString()
    assert widerow.scan_all(rows, 100).count() == 9


def loaded(spark, *records):
    return files.parse_records(spark.createDataFrame([(json.dumps(r),) for r in records], "value string")).drop("value", files.CORRUPT)


def test_loads_read_only_the_spans_they_meet(spark, tmp_path):
    path = str(tmp_path / "raw")
    read = lambda fresh: [f for f in fresh.inputFiles() if str(tmp_path) in f]
    hours = lambda day, *hs: [record(product_id=f"p{h}", scraped_at=f"2024-01-0{day}T{h:02d}:00:00+00:00") for h in hs]
    assert files.load_raw(loaded(spark, *hours(1, 1, 2), *hours(2, 5)), path).count() == 3
    # Another day, and other hours of a known day: nothing of the table is read.
    for rows in (hours(3, 1, 2), hours(1, 5, 6)):
        fresh = files.load_raw(loaded(spark, *rows), path)
        assert read(fresh) == [] and fresh.count() == 2
    # An overlapping span: only that day, and only what is new enters.
    fresh = files.load_raw(loaded(spark, *hours(1, 2, 3), *hours(3, 7)), path)
    assert fresh.count() == 2 and {f.split("scraped_date=")[1][:10] for f in read(fresh)} == {"2024-01-01"}
    # The same rows again, in another order: known by their mark.
    assert files.load_raw(loaded(spark, *hours(3, 7), *hours(1, 3, 2)), path).count() == 0
    assert spark.read.parquet(path).count() == 9


def test_a_load_that_left_no_mark_is_compared(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = loaded(spark, record(), record(scraped_at=AT.format(2)), record(scraped_at="drop"))
    files.load_raw(rows, path)
    for mark in (tmp_path / "raw" / "_loads").iterdir():
        mark.rename(tmp_path / mark.name)
    assert files.load_raw(rows, path).count() == 0 and spark.read.parquet(path).count() == 3


def test_offsets_of_a_total_limit():
    rng = random.Random(1)
    for _ in range(500):
        start = {p: rng.randrange(50) for p in range(rng.randrange(1, 7))}
        end = {p: s + rng.choice([0, 1, rng.randrange(40)]) for p, s in start.items()}
        limit, there = rng.randrange(120), sum(end[p] - start[p] for p in start)
        stops = kafka.end_offsets(start, end, limit)
        assert all(start[p] <= stops[p] <= end[p] for p in start)
        assert sum(stops[p] - start[p] for p in start) == min(limit, there)
    assert kafka.end_offsets({}, {0: 3, 1: 9}, 8) == {0: 3, 1: 5}


def test_a_stream_ends_at_the_limit(spark, tmp_path):
    for k in range(6):
        lines(tmp_path / "in", f"{k}.jsonl", *[f"r{k}-{j}" for j in range(7)])
    texts = ingest.text_stream(spark, str(tmp_path / "in"), max_files=1)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    ingest.start_limited(texts, ingest.folder_sink("o", out), cp, 17).awaitTermination()
    assert spark.read.parquet(out).count() == 17
    # Started again, with more files, it has nothing more to deliver.
    lines(tmp_path / "in", "9.jsonl", "more")
    ingest.start_limited(texts, ingest.folder_sink("o", out), cp, 17).awaitTermination()
    got = [r.value for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) == 17


def test_rate_quantiles_exact_and_sketched(spark):
    rng = random.Random(9)
    data = [(rng.randrange(900), rng.choice([None, rng.expovariate(0.01)])) for _ in range(30_000)]
    rows = spark.createDataFrame(data, "s long, price double").withColumn("scraped_at", F.timestamp_seconds("s"))
    by = {}
    for s, price in data:
        by.setdefault(s // 300, []).append(price)
    exact, sketched = ({int(r.window_start.timestamp()) // 300: r for r in live.event_rates(rows, approx=a).collect()} for a in (False, True))
    for w, prices in by.items():
        known = sorted(p for p in prices if p is not None)
        for name, share in live.SHARES.items():
            assert exact[w][name] == known[math.ceil(share * len(known)) - 1]
            rank = sum(p <= sketched[w][name] for p in known)
            assert abs(rank - share * len(known)) <= live.SKETCH_RANK_ERROR * len(known) + 1
        assert exact[w].events == sketched[w].events == len(prices)


def test_the_sketch_of_a_window_is_bounded(spark):
    sizes = []
    for n in (10_000, 1_000_000):
        agg = spark.range(n).agg(F.octet_length(F.kll_sketch_agg_double(F.col("id").cast("double"), F.lit(live.SKETCH_K))).alias("b"))
        sizes.append(agg.first().b)
    assert sizes[1] < 1.5 * sizes[0] < 15_000
