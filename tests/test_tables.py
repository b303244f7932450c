"""Stores: what a change writes, what counts, what stays after a break."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F
from tallyspark.operators import contracts, tables
from tallyspark.plans import jobs

VIDEO = "video_id string, video_url string, title string, load_seq long"


def videos(spark, *rows):
    return spark.createDataFrame([(k, u, "t", n) for k, u, n in rows], VIDEO)


def parts(store, name="seb.videos"):
    return {int(b): tuple(p) for b, p in store.manifest()[name]["parts"].items()}


def on_disk(root):
    return {os.path.relpath(d, root) for d, _, names in os.walk(root) if any(n.endswith(".parquet") for n in names)}


@pytest.fixture
def store(spark, tmp_path):
    return tables.Store(spark, str(tmp_path / "store"), buckets=64, keep=0)


def fill(spark, store, n=300):
    with store.change() as change:
        return change.upsert("seb.videos", videos(spark, *((f"v{i}", f"u{i}", 1) for i in range(n))), "video_id", "load_seq")


def test_a_batch_writes_the_buckets_it_changes(spark, store):
    assert fill(spark, store) == len(parts(store)) > 50
    before = parts(store)
    with store.change() as change:
        assert change.upsert("seb.videos", videos(spark, ("v7", "new", 2)), "video_id", "load_seq") == 1
    after = parts(store)
    changed = {b for b in after if after[b] != before.get(b)}
    assert len(changed) == 1 and set(after) == set(before)
    rows = {r.video_id: r.video_url for r in store.read("seb.videos").collect()}
    assert rows == {f"v{i}": f"u{i}" for i in range(300)} | {"v7": "new"}
    # The bucket that was written anew is gone from the disk, the others are where they were.
    assert on_disk(store.root) == {p for held in after.values() for p in held}


def test_the_same_batch_again_changes_nothing(spark, store):
    fill(spark, store)
    version, held, files = store.version, store.manifest(), on_disk(store.root)
    assert fill(spark, store) == 0
    assert (store.version, store.manifest(), on_disk(store.root)) == (version, held, files)


def test_the_later_row_of_a_batch_wins_and_new_keys_come_in(spark, store):
    fill(spark, store, 3)
    with store.change() as change:
        change.upsert("seb.videos", videos(spark, ("v1", "a", 5), ("v1", "b", 9), ("v1", "c", 7), ("w", "d", 1)), "video_id", "load_seq")
    assert {(r.video_id, r.video_url) for r in store.read("seb.videos").collect()} == {("v0", "u0"), ("v1", "b"), ("v2", "u2"), ("w", "d")}


def test_a_broken_change_leaves_the_old_set(spark, store):
    fill(spark, store, 20)
    before, files = store.manifest(), on_disk(store.root)
    with pytest.raises(RuntimeError), store.change() as change:
        change.upsert("seb.videos", videos(spark, ("v1", "half", 2)), "video_id", "load_seq")
        assert change.read("seb.videos").filter("video_id = 'v1'").first().video_url == "half"
        assert store.read("seb.videos").filter("video_id = 'v1'").first().video_url == "u1"
        raise RuntimeError("broken off")
    assert store.manifest() == before and on_disk(store.root) == files


def test_what_a_dead_writer_left_goes_with_the_next_change(spark, store):
    """A process that dies has no chance to clean up."""
    fill(spark, store, 20)
    dead = tables.Change(store)
    dead.upsert("seb.videos", videos(spark, ("v1", "dead", 2)), "video_id", "load_seq")
    assert len(on_disk(store.root)) > len(parts(store))
    with store.change() as change:
        change.upsert("seb.videos", videos(spark, ("v2", "live", 2)), "video_id", "load_seq")
    assert on_disk(store.root) == {p for held in parts(store).values() for p in held}
    assert store.read("seb.videos").filter("video_id = 'v1'").first().video_url == "u1"


def test_a_second_writer_fails(spark, tmp_path):
    store = tables.Store(spark, str(tmp_path / "s"))
    fill(spark, store, 5)
    with pytest.raises(contracts.ContractError, match="another writer"), store.change() as change:
        with store.change() as quicker:
            quicker.upsert("seb.videos", videos(spark, ("v1", "first", 2)), "video_id", "load_seq")
        change.upsert("seb.videos", videos(spark, ("v1", "second", 3)), "video_id", "load_seq")
    assert store.read("seb.videos").filter("video_id = 'v1'").first().video_url == "first"


def test_older_sets_stay_as_long_as_said(spark, tmp_path):
    store = tables.Store(spark, str(tmp_path / "s"), buckets=4, keep=1)
    for n in range(4):
        with store.change() as change:
            change.upsert("seb.videos", videos(spark, ("a", f"u{n}", n)), "video_id", "load_seq")
    assert store.versions() == [2, 3]
    assert [store.read("seb.videos", v).first().video_url for v in (2, 3)] == ["u2", "u3"]


def test_rows_are_checked_while_they_are_written(spark, store):
    fill(spark, store, 5)
    before, files = store.manifest(), on_disk(store.root)
    for bad in ((None, "u", "t", 1), ("x", None, "t", 1), ("x", "u", None, 1)):
        with pytest.raises(contracts.ContractError, match="break"), store.change() as change:
            change.upsert("seb.videos", spark.createDataFrame([bad, ("good", "u", "t", 1)], VIDEO), "video_id", "load_seq")
        assert store.manifest() == before and on_disk(store.root) == files
    with pytest.raises(contracts.ContractError, match="no table"), store.change() as change:
        change.upsert("seb.unknown", videos(spark, ("a", "b", 1)), "video_id", "load_seq")
    with pytest.raises(contracts.ContractError, match="no table"):
        contracts.check_table(videos(spark, ("a", "b", 1)), "seb.video", "video_id")


def test_append_counts_in_the_pass_that_writes(spark, store):
    rows = spark.createDataFrame([("s1", 1, "suppress", "r", "b", dt.datetime(2024, 1, 1)), ("s2", 2, "suppress", "r", "b", dt.datetime(2024, 1, 1))], "suppression_id string, voter_id long, action string, reason string, requested_by string, requested_at timestamp")
    with store.change() as change:
        change.create("voter.suppressions", rows, "suppression_id")
        marked = rows.withColumn("known", F.col("voter_id") == 2)
        counts = change.append("voter.suppressions", marked, "suppression_id", ~F.col("known"), {"logged": F.count_if(~F.col("known")), "skipped": F.count_if(F.col("known"))})
    assert counts == {"logged": 1, "skipped": 1} and [r.suppression_id for r in store.read("voter.suppressions").collect()] == ["s1"]
    for n in range(3):
        with store.change() as change:
            change.append("voter.suppressions", rows.filter("voter_id = 2").withColumn("suppression_id", F.lit(f"t{n}")), "suppression_id")
    with store.change() as change:
        assert change.compact("voter.suppressions", 0) == len(parts(store, "voter.suppressions"))
    assert {len(p) for p in parts(store, "voter.suppressions").values()} == {1} and store.read("voter.suppressions").count() == 4


def test_references(spark, store):
    fill(spark, store, 2)
    point = spark.createDataFrame([(1, "v0", "n", "k", "u")], "source_id long, video_id string, name string, source_type string, url string")
    with store.change() as change:
        change.upsert("seb.sources", point, "source_id", "source_id")
        change.require_references("seb.sources", "video_id", "seb.videos", "video_id")
    with pytest.raises(contracts.ContractError, match="lacks"), store.change() as change:
        change.upsert("seb.sources", point.withColumn("source_id", F.lit(2).cast("long")).withColumn("video_id", F.lit("gone")), "source_id", "source_id")
        change.require_references("seb.sources", "video_id", "seb.videos", "video_id")
    assert store.read("seb.sources").count() == 1


ASKED = "suppression_id string, voter_id long, action string, reason string, requested_by string, supersedes string, requested_at timestamp"


def asked(spark, *rows):
    return spark.createDataFrame([(i, v, a, "r", "b", s, None) for i, v, a, s in rows], ASKED)


def test_requests_are_logged_once(spark, store):
    at = dt.datetime(2024, 3, 1)
    people = spark.range(50).withColumnRenamed("id", "voter_id")

    def log(*rows, **more):
        with store.change() as change:
            return jobs.log_suppressions(change, asked(spark, *rows), at, people, **more)

    assert log(*((f"s{i}", i, "suppress", None) for i in range(40))) == {"logged": 40, "skipped": 0}
    assert log(("s1", 1, "suppress", None), ("n1", 1, "unsuppress", "s1"), ("n2", 2, "unsuppress", "n1")) == {"logged": 2, "skipped": 1}
    assert store.read("voter.suppressions").count() == 42 and {r.requested_at for r in store.read("voter.suppressions").collect()} == {at}
    before = store.manifest()
    for bad, why in (((("x", 1, "unsuppress", "gone"),), "supersedes"), ((("x", 99, "suppress", None),), "unknown"), ((("x", 1, "suppress", None), ("x", 2, "suppress", None)), "2 times"), ((("x", 1, "hide", None),), "action")):
        with pytest.raises(contracts.ContractError, match=why):
            log(*bad)
    assert store.manifest() == before
    assert log(("x", 1, "suppress", None), ("x", 1, "suppress", None), once=False) == {"logged": 1, "skipped": 0}


def test_a_small_batch_reads_few_files(spark, store):
    with store.change() as change:
        jobs.log_suppressions(change, asked(spark, *((f"s{i}", i, "suppress", None) for i in range(500))), dt.datetime(2024, 3, 1))
    files = len(store.read("voter.suppressions").inputFiles())
    batch = asked(spark, ("s7", 7, "suppress", None), ("new", 7, "suppress", None))
    found = tables.Change(store).matching("voter.suppressions", batch, "suppression_id")
    assert files > 50 and len(found.inputFiles()) <= 2 and [r.suppression_id for r in found.collect()] == ["s7"]


def test_manifests_are_whole(spark, store):
    """Readers beside a writer see one set or the next, never half of one."""
    fill(spark, store, 4)
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(json.dumps(store.manifest(store.version)) != "")

    reader = threading.Thread(target=read)
    keep = tables.Store(spark, store.root, keep=5)
    reader.start()
    for n in range(2, 4):
        with keep.change() as change:
            change.upsert("seb.videos", videos(spark, ("v0", f"n{n}", n)), "video_id", "load_seq")
    done.set()
    reader.join()
    assert seen and all(seen)
