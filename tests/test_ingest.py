"""The ingest as one change: five tables, a summary, and what a break leaves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tallyspark.operators import contracts, tables
from tallyspark.plans import jobs

AT, LATER = dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 1)
D = dt.date
MEETING = (
    "meeting_id long, meeting_date date, day_of_week string, meeting_type string, meeting_format string, chair string, members_present string, quorum_met string, agenda_summary string, "
    "key_decisions string, video_url string, source_url string, compliance_status string, compliance_notes string, controversies string, hours_logged double"
)
CORRECTION = "correction_id string, meeting_id long, target_column string, corrected_value string, reason string, corrected_by string, corrected_at timestamp, load_seq string"


def seed(spark, *meetings, sources=2):
    rows = [(i, day, "Mon", "Regular", "Zoom", chair, "all", "Yes", None, None, url, None, "Unreviewed", None, None, hours) for i, day, chair, url, hours in meetings]
    return {
        "seb.meetings": spark.createDataFrame(rows, MEETING),
        "seb.controversies": spark.createDataFrame([(1, "topic", None, "Active", None, None, None)], "controversy_id long, title string, first_seen_date date, status string, description string, latest_action string, primary_source string"),
        "seb.sources": spark.createDataFrame([(i, "s", "Other", "u", None) for i in range(sources)], "source_id long, name string, source_type string, url string, notes string"),
    }


def feed(spark, *rows):
    return spark.createDataFrame([(k, m, u, "t", d, n) for k, m, u, d, n in rows], "video_id string, meeting_id long, video_url string, title string, published_date date, load_seq long")


def overrides(spark, *rows):
    return spark.createDataFrame([(i, m, c, v, "r", "b", AT, f"f#{n:010d}") for n, (i, m, c, v) in enumerate(rows)], CORRECTION)


@pytest.fixture
def store(spark, tmp_path):
    return tables.Store(spark, str(tmp_path / "store"), buckets=8)


def two(spark):
    return seed(spark, (1, D(2024, 1, 1), "ann", None, 2.0), (2, D(2024, 1, 2), "bob", "https://v/2", None), (3, D(2024, 1, 3), "cy", None, None))


def test_first_run_and_the_same_again(spark, store):
    videos = feed(spark, ("v", None, "https://v/1", D(2024, 1, 1), 1), ("w", 2, "https://v/2", D(2024, 1, 2), 2), ("w", 2, "https://v/2b", D(2024, 1, 2), 3))
    log = overrides(spark, ("c1", 1, "chair", "new"), ("c2", 1, "chair", None), ("c3", 1, "hours_logged", "3.5"))
    got = jobs.ingest(store, two(spark), videos, log, AT)
    assert got == {"seed": {"meetings": 3, "controversies": 1, "sources": 2}, "videos_upserted": 3, "meetings_with_video_url": 2, "corrections": {"logged": 3, "applied": 3, "skipped": 0}}
    base = {r.meeting_id: r for r in store.read("seb.meetings").collect()}
    assert (base[1].chair, base[1].video_url, base[1].source, base[1].loaded_at) == ("ann", "https://v/1", "workbook_v0", AT)
    now = {r.meeting_id: r for r in jobs.meetings_in_effect(store).collect()}
    assert (now[1].chair, now[1].hours_logged, now[2].chair) == (None, 3.5, "bob")
    logged = {r.correction_id: (r.original_value, r.applied_at) for r in store.read("seb.meeting_corrections").collect()}
    assert logged == {"c1": ("ann", AT), "c2": ("new", AT), "c3": ("2.0", AT)}
    # Once more at a later time: the ledger skips, no bucket changes, the set keeps its number.
    again = jobs.ingest(store, two(spark), videos, log, LATER)
    assert again["corrections"] == {"logged": 0, "applied": 0, "skipped": 3} and store.version == 0


def test_later_runs_go_on_from_the_ledger(spark, store):
    jobs.ingest(store, two(spark), None, overrides(spark, ("c9", 1, "chair", "first")), AT)
    got = jobs.ingest(store, two(spark), None, overrides(spark, ("c9", 1, "chair", "first"), ("c1", 1, "chair", "second"), ("c2", 1, "chair", "third"), ("c0", 2, "quorum_met", "No")), LATER)
    assert got["corrections"] == {"logged": 3, "applied": 3, "skipped": 1} and got["meetings_with_video_url"] == 3
    rows = {r.correction_id: r.original_value for r in store.read("seb.meeting_corrections").collect()}
    assert rows == {"c9": "ann", "c1": "first", "c2": "second", "c0": "Yes"}
    assert {r.meeting_id: (r.chair, r.quorum_met) for r in jobs.meetings_in_effect(store).collect()} == {1: ("third", "Yes"), 2: ("bob", "No"), 3: ("cy", "Yes")}
    # Another seed never loses an override.
    jobs.ingest(store, seed(spark, (1, D(2024, 1, 1), "dee", None, None)), None, None, LATER)
    assert {r.meeting_id: r.chair for r in jobs.meetings_in_effect(store).collect()} == {1: "third", 2: "bob", 3: "cy"}


def test_an_id_logged_for_another_meeting_is_skipped(spark, store):
    """Ids are looked up by meeting first; one that has moved to another meeting, there or not, is known all the same."""
    jobs.ingest(store, two(spark), None, overrides(spark, ("c1", 1, "chair", "first"), ("c2", 2, "chair", "first")), AT)
    got = jobs.ingest(store, two(spark), None, overrides(spark, ("c1", 2, "chair", "moved"), ("c3", 2, "chair", "second"), ("c4", 1, "chair", "third")), LATER)
    assert got["corrections"] == {"logged": 2, "applied": 2, "skipped": 1}
    rows = {r.correction_id: (r.meeting_id, r.original_value) for r in store.read("seb.meeting_corrections").collect()}
    assert rows == {"c1": (1, "ann"), "c2": (2, "bob"), "c3": (2, "first"), "c4": (1, "first")}
    got = jobs.ingest(store, two(spark), None, overrides(spark, ("c1", 99, "chair", "gone")), LATER)
    assert got["corrections"] == {"logged": 0, "applied": 0, "skipped": 1} and store.read("seb.meeting_corrections").count() == 4


def test_empty_batches(spark, store):
    got = jobs.ingest(store, two(spark), feed(spark), overrides(spark), AT)
    assert got["videos_upserted"] == 0 and got["corrections"] == {"logged": 0, "applied": 0, "skipped": 0}


def test_gaps_of_old_meetings_are_filled(spark, store):
    jobs.ingest(store, two(spark), None, None, AT)
    got = jobs.ingest(store, seed(spark, (2, D(2024, 1, 2), "bob", "https://v/2", None)), feed(spark, ("v", None, "https://v/3", D(2024, 1, 3), 1)), None, LATER)
    assert got["seed"]["meetings"] == 1 and got["meetings_with_video_url"] == 2
    assert store.read("seb.meetings").filter("meeting_id = 3").first().video_url == "https://v/3"


@pytest.mark.parametrize("fault", ["unknown meeting", "repeated id", "bad row", "unknown reference", "bad override"])
def test_a_refused_run_leaves_the_old_set(spark, store, fault):
    jobs.ingest(store, two(spark), None, None, AT)
    before = store.manifest()
    rows, videos, log = seed(spark, (1, D(2024, 1, 1), "eve", None, 1.0)), feed(spark, ("v", None, "u", D(2024, 1, 1), 1)), overrides(spark, ("c1", 1, "chair", "x"))
    if fault == "unknown meeting":
        log = overrides(spark, ("c1", 1, "chair", "x"), ("c2", 99, "chair", "x"))
    elif fault == "repeated id":
        log = overrides(spark, ("c1", 1, "chair", "x"), ("c1", 2, "chair", "x"))
    elif fault == "bad row":
        rows = seed(spark, (1, D(2024, 1, 1), "eve", None, 25.0))
    elif fault == "unknown reference":
        videos = feed(spark, ("v", 77, "u", D(2024, 1, 1), 1))
    else:
        log = overrides(spark, ("c1", 1, "meeting_date", "x"))
    with pytest.raises(contracts.ContractError):
        jobs.ingest(store, rows, videos, log, LATER)
    assert store.manifest() == before and {r.chair for r in store.read("seb.meetings").collect()} == {"ann", "bob", "cy"}


@pytest.mark.parametrize("stop", ["seb.meetings", "seb.controversies", "seb.meeting_corrections"])
def test_a_run_that_stops_between_tables_leaves_the_old_set(spark, store, monkeypatch, stop):
    jobs.ingest(store, two(spark), None, None, AT)
    before = store.manifest()
    write = tables.Change._write

    def stops(self, name, *args, **kwargs):
        out = write(self, name, *args, **kwargs)
        if name == stop:
            raise KeyboardInterrupt
        return out

    new = seed(spark, (1, D(2024, 1, 1), "eve", None, 1.0), sources=4)
    new["seb.controversies"] = new["seb.controversies"].withColumn("status", F.lit("Resolved"))
    run = lambda: jobs.ingest(store, new, feed(spark, ("v", None, "u", D(2024, 1, 3), 1)), overrides(spark, ("c1", 1, "chair", "x")), LATER)
    with monkeypatch.context() as m:
        m.setattr(tables.Change, "_write", stops)
        with pytest.raises(KeyboardInterrupt):
            run()
    assert store.manifest() == before and "seb.videos" not in store.tables() and store.read("seb.sources").count() == 2
    run()
    assert store.read("seb.sources").count() == 4 and store.read("seb.controversies").first().status == "Resolved" and jobs.meetings_in_effect(store).filter("meeting_id = 1").first().chair == "x"
