"""Known-input tests of views, ledgers, merges, reads, jobs and publication."""

import datetime as dt
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tallyspark.functions import address, dates, text
from tallyspark.operators import contracts, ledger, limiter, merge, publish, reads, views
from tallyspark.plans import jobs
from tallyspark.plans.queries import QUERIES
from tallyspark.sources import feeds

VOTER = "voter_id long, county string, precinct string, status string, residence_zip5 string, birth_year int"
SUPPRESSION = "suppression_id string, voter_id long, action string, reason string, requested_by string, supersedes string, requested_at timestamp"
MEETING = "meeting_id long, meeting_date date, compliance_status string, quorum_met string, controversies string, video_url string, hours_logged double, chair string"
D = dt.date


def voters(spark, *rows):
    return spark.createDataFrame(list(rows), VOTER)


def asked(spark, *rows):
    return spark.createDataFrame([(i, v, a, "r", "b", s, dt.datetime(2024, 1, d)) for i, v, a, s, d in rows], SUPPRESSION)


def meetings(spark, *rows):
    return spark.createDataFrame([(i, d, *(*rest, *[None] * 6)[:6]) for i, d, *rest in rows], MEETING)


def test_county_rollup_follows_the_ledger(spark):
    people = voters(spark, (1, "A", "p", "Active", "1", 1950), (2, "A", "p", "Active", "2", 1960), (3, "A", None, "Inactive", None, None), (4, "B", "q", "Active", "1", 1), (5, None, "q", "Active", "1", 1))
    count = lambda log: {(r.county, r.status): r.voter_count for r in views.county_summary(views.public_voters(people, log)).collect()}
    assert count(asked(spark)) == {("A", "Active"): 2, ("A", "Inactive"): 1, ("B", "Active"): 1}
    one = ("s1", 1, "suppress", None, 1)
    assert count(asked(spark, one))["A", "Active"] == 1
    assert count(asked(spark, one, ("s2", 1, "unsuppress", "s1", 2)))["A", "Active"] == 2
    assert count(asked(spark, one, ("s0", 1, "unsuppress", "s1", 1)))["A", "Active"] == 1


@pytest.mark.parametrize("n,want", [(5, (None, True)), (24, (None, True)), (25, (25, False))])
def test_small_cells(spark, n, want):
    rows = views.precinct_summary(voters(spark, *((i, "A", "p", "Active", "1", 1950) for i in range(n)))).collect()
    assert [(r.voter_count, r.suppressed_for_size) for r in rows] == [want]


def test_quarters_and_overlap(spark):
    m = meetings(spark, (1, D(2024, 1, 5), "Clean", "Yes", "text"), (2, D(2024, 3, 5), "Clean", "Yes (3, then 4)", " None "), (3, D(2024, 4, 5), "Clean", "No", ""))
    rows = {(r.year, r.quarter): (r.meeting_count, r.quorum_met_count, r.controversy_meeting_count) for r in views.meeting_quarter(m).collect()}
    assert rows == {(2024, 1): (2, 1, 1), (2024, 2): (1, 0, 0)}
    people = voters(spark, (1, "A", "p", "Active", "1", 1950), (2, "A", "p", "Inactive", "1", 1950))
    out = views.overlap(m, people, asked(spark))
    assert out.columns == views.OVERLAP and out.count() == 4
    contracts.no_personal_columns(out)
    assert views.overlap(m, people.limit(0), asked(spark)).count() == 0 and views.overlap(m.limit(0), people, asked(spark)).count() == 0


def test_pages(spark):
    df = spark.range(10).withColumnRenamed("id", "meeting_id").withColumn("meeting_date", F.lit("2024-01-01").cast("date"))
    assert [r.meeting_id for r in reads.meetings_page(df, 3, 2).collect()] == [7, 6, 5]
    for bad in ((0, 0), (501, 0), (1, -1)):
        with pytest.raises(ValueError):
            reads.meetings_page(df, *bad)
    with pytest.raises(ValueError):
        reads.overlap_page(df, year=1999)


def test_gap_fill_only_where_one_video_fits(spark):
    m = meetings(spark, (1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3), None, None, None, "kept"), (4, D(2024, 1, 4)))
    v = spark.createDataFrame([("a", None, "u1", D(2024, 1, 1)), ("b", None, "u1", D(2024, 1, 1)), ("c", None, "u2", D(2024, 1, 2)), ("d", None, "u3", D(2024, 1, 2)), ("e", None, "u4", D(2024, 1, 3)), ("f", 9, "u5", D(2024, 1, 4))], "video_id string, meeting_id long, video_url string, published_date date")
    assert {r.meeting_id: r.video_url for r in merge.fill_video_urls(m, v).collect()} == {1: "u1", 2: None, 3: "kept", 4: None}


def test_merge_later_row_wins_and_again_changes_nothing(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 2, "p"), ("a", 3, "q"), ("c", 1, None)], "k string, n int, v string")
    once = merge.merge(old, new, "k", "n")
    want = {("a", 3, "q"), ("b", 1, "y"), ("c", 1, None)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in merge.merge(once, new, "k", "n").collect()}


def corrections(spark, *rows):
    return spark.createDataFrame([(i, m, c, v, "why", "me", dt.datetime(2024, 1, d), s) for i, m, c, v, d, s in rows], "correction_id string, meeting_id long, target_column string, corrected_value string, reason string, corrected_by string, corrected_at timestamp, load_seq int")


def test_overrides(spark):
    base = meetings(spark, (1, D(2024, 1, 1), "Unreviewed", None, None, "u", 2.0, "old"), (2, D(2024, 1, 2), "Unreviewed"))
    log = corrections(spark, ("c1", 1, "chair", "new", 9, 1), ("c2", 1, "chair", None, 1, 2), ("c3", 1, "hours_logged", "3.5", 1, 3), ("c4", 9, "chair", "x", 1, 4))
    got = {r.meeting_id: (r.chair, r.hours_logged, r.video_url) for r in ledger.effective(base, log).collect()}
    assert got == {1: (None, 3.5, "u"), 2: (None, None, None)}
    before = {r.correction_id: r.original_value for r in ledger.snapshots(log, base).collect()}
    assert before == {"c1": "old", "c2": "new", "c3": "2.0"}
    # The latest view goes by time, the projection by order of entry.
    assert {r.correction_id for r in ledger.corrections_latest(log).filter("meeting_id = 1").collect()} == {"c1", "c3"}
    assert ledger.as_of(base, log, F.lit("2024-01-02").cast("timestamp")).filter("meeting_id = 1").first().chair is None
    assert ledger.effective(base, log.limit(0)).filter("meeting_id = 1").first().chair == "old"


def test_each_asked_row_has_its_own_time(spark):
    """As many rows as asked, each that of a single replay at its time; any span gives them."""
    rng = random.Random(4)
    base = meetings(spark, *((i, D(2024, 1, 1), "Unreviewed", None, None, f"u{i}", float(i), f"c{i}") for i in range(6)))
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h) for d in range(0, 200, 9) for h in (0, 5)]
    rows = [(f"k{n}", 0 if rng.random() < 0.4 else rng.randrange(8), rng.choice(["chair", "video_url", "hours_logged"]), rng.choice([None, "1.5", "2", "x"]), n) for n in range(160)]
    log = spark.createDataFrame([(i, m, c, v, "b", "r", rng.choice(times), rng.randrange(99)) for i, m, c, v, n in rows], "correction_id string, meeting_id long, target_column string, corrected_value string, corrected_by string, reason string, corrected_at timestamp, load_seq int")
    asked = [(n, rng.randrange(9), rng.choice([*times, times[3] - dt.timedelta(days=900), None])) for n in range(120)] + [(200, None, times[0])]
    frame = spark.createDataFrame(asked, "ask int, meeting_id long, at timestamp")
    columns = ["video_url", "hours_logged", "chair"]
    by_time = {t: {r.meeting_id: tuple(r[c] for c in columns) for r in ledger.as_of(base, log, F.lit(t).cast("timestamp")).collect()} for t in {a[2] for a in asked if a[2]}}
    plain = {r.meeting_id: tuple(r[c] for c in columns) for r in base.collect()}
    want = {n: (by_time[t] if t else plain).get(m, (None, None, None)) for n, m, t in asked}
    for span in (ledger.SPAN_S, 86400 * 3, 86400 * 10000):
        got = ledger.as_of_each(base, log, frame, span=span).collect()
        assert len(got) == len(asked) and {r.ask: tuple(r[c] for c in columns) for r in got} == want


def test_entities_of_many_rows_are_cut_into_spans(spark):
    """Whether none, some or all entities are cut, as many rows and the same; a null key and a null time too."""
    rng = random.Random(5)
    base = meetings(spark, *((i, D(2024, 1, 1), "Unreviewed", None, None, f"u{i}", float(i), f"c{i}") for i in range(6)))
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(days=d) for d in range(0, 200, 9)]
    log = spark.createDataFrame([(f"k{n}", 0 if rng.random() < 0.5 else rng.choice([None, 1, 2, 7]), rng.choice(["chair", "video_url", "hours_logged"]), rng.choice([None, "1.5", "2", "x"]), rng.choice([None, *times]), rng.randrange(99)) for n in range(160)], "correction_id string, meeting_id long, target_column string, corrected_value string, corrected_at timestamp, load_seq int")
    frame = spark.createDataFrame([(n, rng.choice([None, 0, 0, 1, 2, 3, 9]), rng.choice([None, *times])) for n in range(120)], "ask int, meeting_id long, at timestamp")
    rows = [sorted(map(str, ledger.as_of_each(base, log, frame, span=86400 * 20, most=most).collect())) for most in (10**6, 40, 0)]
    assert len(rows[0]) == 120 and rows[0] == rows[1] == rows[2]


@pytest.mark.parametrize("name, most", [("meetings_at_instants", 4.5), ("applied_corrections", 3.5), ("ingest_runs", 8)])
def test_rows_are_sent_few_times(spark, sf, shuffled, name, most):
    """Shuffled records a line of the input."""
    # The ingest writes as it is called, so the call counts too.
    sent = shuffled(lambda: QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save())
    assert 0 < sent <= most * spark.read.parquet(f"{sf}/lineitem.parquet").count()


def test_suppressions_job(spark):
    people = voters(spark, (1, "A", "p", "Active", "1", 1950), (2, "A", "p", "Active", "1", 1950))
    log = asked(spark, ("s1", 1, "suppress", None, 1))
    batch = asked(spark, ("s1", 1, "suppress", None, 1), ("s2", 1, "unsuppress", "s1", 2), ("s3", 2, "unsuppress", "s2", 3))
    table, counts = jobs.apply_suppressions(batch, log, people)
    assert tuple(counts.first()) == (2, 1) and table.count() == 3
    for bad in (("s4", 1, "unsuppress", "s9", 1), ("s4", 7, "suppress", None, 1), ("s4", 1, "unsuppress", None, 1), ("s4", 1, "other", None, 1), (" ", 1, "suppress", None, 1)):
        with pytest.raises(contracts.ContractError):
            jobs.apply_suppressions(asked(spark, bad), log, people)
    with pytest.raises(contracts.ContractError):
        jobs.apply_suppressions(asked(spark, ("s5", 1, "suppress", None, 1), ("s5", 1, "suppress", None, 2)), log, people)
    assert jobs.apply_suppressions(asked(spark, ("s4", 7, "suppress", None, 1)), log, people, require_voter=False)[0].count() == 2


def test_ingest_job(spark):
    seed = meetings(spark, (1, D(2024, 1, 1), "Unreviewed", None, None, None, None, "a"))
    feed = spark.createDataFrame([("v", None, "u", D(2024, 1, 1), 1)], "video_id string, meeting_id long, video_url string, published_date date, load_seq int")
    log = corrections(spark, ("c1", 1, "chair", "b", 1, 1))
    out, videos, summary = jobs.ingest_meetings(seed.limit(0), seed, feed.limit(0), feed, log)
    assert out.first().chair == "b" and out.first().video_url == "u" and videos.count() == 1
    assert tuple(summary.first())[:2] == (1, 1)
    # A second run keeps the override.
    assert jobs.ingest_meetings(out, seed, videos, None, log)[0].first().chair == "b"


TITLES = [("Board April 15, 2026", D(2026, 4, 15)), ("x Sept 3 2025", D(2025, 9, 3)), ("JAN 21, 2026 Day 2", D(2026, 1, 21)), ("03.18.26 board", D(2026, 3, 18)), ("Feb 30, 2025", None), ("Feb 30, 2025 / 12.09.25", D(2025, 12, 9)), ("none", None), (None, None)]


def test_title_dates(spark):
    rows = spark.createDataFrame([(t,) for t, _ in TITLES], "t string").select(dates.title_date(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == [d for _, d in TITLES]


@pytest.mark.parametrize("value,want", [("20240131", D(2024, 1, 31)), (" 1/5/2024 ", D(2024, 1, 5)), ("2024-1-5", D(2024, 1, 5)), ("", None), ("31.1.2024", None), ("20241331", None)])
def test_file_dates(spark, value, want):
    assert spark.range(1).select(dates.file_date(F.lit(value))).first()[0] == want


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    lit = F.lit
    assert one(text.title_case(lit("stand-in o'brien 3rd"))) == "Stand-In O'Brien 3Rd"
    assert one(text.squeeze(lit("  a \t b\n"))) == "a b" and one(text.squeeze(lit("  "))) is None
    assert [one(text.zip5(lit(x))) for x in ("3030", "303031", "")] == ["03030", "303031", None]
    assert [one(text.vendor_id(lit(x))) for x in ("TS12", "ts7", "8", "x8", "")] == [12, 7, 8, None, None]
    assert [one(address.street_suffix(lit(x))) for x in ("ST", "st", "St.", "STREET", "RANDOM", "")] == ["St", "St", "St", "St", "Random", None]
    a, b, c = (one(text.day_salted_hash(lit(ip), lit(t).cast("timestamp"), "s")) for ip, t in (("1", "2024-01-01 01:00:00"), ("1", "2024-01-01 23:00:00"), ("1", "2024-01-02 01:00:00")))
    assert a == b != c and len(a) == 16
    for line, want in (("123 MAIN ST", ("123", "MAIN ST")), ("PO BOX 17", (None, "PO BOX 17")), ("123", (None, "123")), ("", (None, None))):
        assert tuple(spark.range(1).select(*address.split_first_line(lit(line))).first()) == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 99999), st.sampled_from(["Peach", "Old Mill", "Third"]), st.sampled_from(["st", "Ave.", "PKWY"]), st.sampled_from([None, "Apt 4", "Unit 12"]), st.sampled_from(["atlanta", "stand-in"]), st.integers(10000, 99999)), min_size=1, max_size=20))
def test_address_round_trip(spark, rows):
    df = spark.createDataFrame([(i, str(h), n, s, a, c, str(z)) for i, (h, n, s, a, c, z) in enumerate(rows)], "voter_id long, house_number string, street_name string, street_suffix string, apartment string, city string, zip5 string")
    for r in jobs.standard_addresses(df).collect():
        h, n, s, a, c, z = rows[r.voter_id]
        assert (r.house_number, r.street_name, r.street_suffix, r.apartment, r.city, r.zip5, r.bad) == (str(h), n, {"st": "St", "Ave.": "Ave", "PKWY": "Pkwy"}[s], a, "-".join(p.title() for p in c.split("-")), str(z), False)


def test_limiter(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(k, "a", start + dt.timedelta(milliseconds=k * 100)) for k in range(101)] + [(500, "a", start + dt.timedelta(seconds=60)), (600, "b", start + dt.timedelta(seconds=5))]
    out = {r.event_id: r for r in limiter.limited(spark.createDataFrame(rows, "event_id long, ip string, ts timestamp")).collect()}
    assert all(out[k].allowed for k in range(100)) and not out[100].allowed and 1 <= out[100].retry_after <= 60
    assert out[500].allowed and out[600].allowed


def test_limiter_folds_a_caller_over_batches(spark):
    """A caller of many batches gives what it gives in one, and no plan holds its history in one frame."""
    start = dt.datetime(2024, 1, 1)
    rows = [(k, "hot" if k % 3 else f"c{k % 7}", start + dt.timedelta(seconds=k // 5)) for k in range(3000)] + [(9000, None, start)]
    df = spark.createDataFrame(rows, "event_id long, ip string, ts timestamp")
    want, open_ = {}, {}
    for k, ip, ts in rows:
        t = (ts - start).total_seconds()
        first, n = open_.get(ip, (None, 0))
        if first is None or t - first >= 60:
            first, n = t, 0
        want[k] = (ip, n < 100, 0 if n < 100 else max(1, int(60 - (t - first))))
        open_[ip] = (first, n + (n < 100))
    out = limiter.limited(df)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert {r.event_id: (r.ip, r.allowed, r.retry_after) for r in limiter.limited(df).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_export_and_manifest(spark, tmp_path):
    people = voters(spark, (1, "A", "p", "Active", "1", 1950))
    m = meetings(spark, (1, D(2024, 1, 5), "Clean", "Yes", "text"))
    county = views.county_summary(people).select("county", "status", "voter_count")
    relations = {"seb.meetings": m, "voter.county_registration_summary": county, "analytics.seb_voter_overlap": views.overlap(m, people, asked(spark))}
    publish.export(relations, f"{tmp_path}/out")
    rows = publish.manifest(spark, f"{tmp_path}/out").collect()
    assert {r.filename.split("/")[0] for r in rows} == {f"{s}.{k}" for s in ("seb_meetings", "voter_county_registration", "seb_voter_overlap") for k in ("csv", "parquet")}
    assert all(r.bytes > 0 and len(r.sha256) == 64 for r in rows)
    assert publish.freshness(spark, f"{tmp_path}/out/seb_meetings.parquet").first().built_at is not None
    with pytest.raises(Exception):
        publish.freshness(spark, f"{tmp_path}/none")


ATOM = """<?xml version="1.0"?><feed xmlns:yt="y" xmlns:media="m"><entry><yt:videoId>abc</yt:videoId><title> Board 03.18.26 </title><link href="https://y.example/abc"/><published>2026-03-19T01:00:00+00:00</published><media:group><media:description></media:description></media:group></entry>
<entry><yt:videoId>def</yt:videoId><title>No date</title><published>2026-02-19T01:00:00+00:00</published></entry></feed>"""


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(ATOM)
    rows = {r.video_id: r for r in feeds.video_rows(feeds.read_feed(spark, f"{tmp_path}/feed.xml")).collect()}
    assert rows["abc"].published_date == D(2026, 3, 18) and rows["abc"].description is None and rows["abc"].video_url == "https://y.example/abc"
    assert rows["def"].published_date == D(2026, 2, 19) and rows["def"].video_url.endswith("watch?v=def")
    assert feeds.read_ledger(spark, f"{tmp_path}/none", "id string").count() == 0


def test_views_across_pipelines_come_last(spark):
    from tallyspark.operators import views

    builders = {name: (lambda n=name: spark.range(1).selectExpr(f"'{n}' AS name")) for name in ("voter.b", "analytics.a", "seb.c")}
    for _ in range(2):
        assert views.register(spark, builders) == ["seb.c", "voter.b", "analytics.a"]
    assert spark.table("analytics_a").first().name == "analytics.a"


def test_ledger_keeps_the_order_of_files_and_entries(spark, tmp_path):
    from tallyspark.sources import feeds

    (tmp_path / "b.json").write_text("".join(f'{{"id": "b{k}"}}\n' for k in (2, 1)))
    (tmp_path / "a.json").write_text("".join(f'{{"id": "a{k}"}}\n' for k in (9, 3, 5)))
    rows = feeds.read_ledger(spark, str(tmp_path), "id string").orderBy("load_seq").collect()
    assert [r.id for r in rows] == ["a9", "a3", "a5", "b2", "b1"]
    assert feeds.read_ledger(spark, f"{tmp_path}/none", "id string").count() == 0


def test_registry_load(spark):
    import datetime as dt

    from tallyspark.plans import jobs

    at = dt.datetime(2024, 5, 1)
    schema = "voter_id long, last_name string, source string, loaded_at timestamp"
    known = spark.createDataFrame([(1, "Old", "manual", None), (2, "Stays", "manual", None)], schema)
    good = spark.createDataFrame([(1, "New"), (3, "More")], "voter_id long, last_name string")
    rows = {r.voter_id: (r.last_name, r.source, r.loaded_at) for r in jobs.load_registry(known, good, "file", at).collect()}
    assert rows == {1: ("New", "file", at), 2: ("Stays", "manual", None), 3: ("More", "file", at)}


def test_endpoints_show_their_columns_only(spark):
    rows = spark.createDataFrame([(1, "a", "u", "t", D(2024, 1, 2), None, "secret"), (1, "b", "u", "t", None, None, "secret"), (1, "c", "u", "t", D(2024, 1, 1), None, "secret"), (2, "d", "u", "t", None, None, "secret")], "meeting_id long, video_id string, video_url string, title string, published_date date, description string, transcript string")
    got = reads.meeting_videos(rows, 1)
    assert got.columns == ["video_id", "video_url", "title", "published_date", "description"] and [r.video_id for r in got.collect()] == ["c", "a", "b"]
    with pytest.raises(contracts.ContractError, match="description"):
        reads.projected(rows.drop("description"), "meeting_videos")


def test_part_files_have_a_bounded_number_of_rows(spark, tmp_path):
    n = 25
    relations = {
        "seb.meetings": spark.range(n).coalesce(1),
        "voter.county_registration_summary": spark.range(3).withColumnRenamed("id", "voter_count"),
        "analytics.seb_voter_overlap": spark.range(3).withColumnRenamed("id", "meeting_count"),
    }
    publish.export(relations, str(tmp_path), part_rows=10)
    assert [spark.read.parquet(str(f)).count() for f in sorted((tmp_path / "seb_meetings.parquet").glob("part-*"))] == [10, 10, 5]
    rows = [r for r in publish.manifest(spark, str(tmp_path)).collect() if r.filename.startswith("seb_meetings.parquet/")]
    assert {(r.filename, r.bytes, r.sha256) for r in publish.manifest(spark, str(tmp_path), whole=300).collect()} == {(r.filename, r.bytes, r.sha256) for r in publish.manifest(spark, str(tmp_path)).collect()}
    assert len(rows) == 3 and all(r.sha256 == hashlib.sha256((tmp_path / r.filename).read_bytes()).hexdigest() for r in rows)


def test_request_log_is_read_as_typed_rows(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"event": "request", "level": "info", "timestamp": "2024-05-01T10:00:00Z", "route": "/v1", "method": "GET", "status": 200, "latency_ms": 1.5, "ip_hash": "ab", "response_bytes": 12, "more": 1}\n{"event": "request", "status": 429}\n')
    rows = sorted(feeds.read_requests(spark, str(tmp_path)).collect(), key=lambda r: r.status)
    assert (rows[0].route, rows[0].latency_ms, rows[0].timestamp, rows[0].response_bytes) == ("/v1", 1.5, dt.datetime(2024, 5, 1, 10), 12) and rows[1].status == 429 and rows[1].route is None and "more" not in rows[0]


def test_digests_of_files_beyond_a_piece(spark, tmp_path, monkeypatch):
    """Large files are read in pieces, their bytes by no scan of Spark."""
    rng = random.Random(1)
    for n, size in enumerate((1, 699, 700, 2000, 250_000)):
        (tmp_path / f"part-{n}").write_bytes(rng.randbytes(size))
    (tmp_path / "other").write_bytes(b"x")
    monkeypatch.setattr(publish, "PIECE", 999)
    got = {r.path.rpartition("/")[2]: (r.length, r.sha256) for r in publish.file_digests(spark, str(tmp_path), whole=700).collect()}
    assert got == {f"part-{n}": (len(b), hashlib.sha256(b).hexdigest()) for n in range(5) for b in [(tmp_path / f"part-{n}").read_bytes()]}
