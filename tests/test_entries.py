"""Entries of ledger files: rules, types, order and repeats."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from tallyspark.functions import dates
from tallyspark.operators import contracts, entries

GOOD = {"id": "s1", "voter_id": 7, "action": "suppress", "reason": "asked", "requested_by": "clerk"}
RIGHT = {"id": "c1", "meeting_id": 7, "column": "chair", "new_value": "x", "reason": "typo", "corrected_by": "clerk"}


def lines(spark, *rows):
    """(file, place, entry or raw text)."""
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v), f, f"{f}#{n:010d}") for f, n, v in rows], "value string, source_file string, load_seq string")


def broken(df):
    return {r.load_seq: r.violations for r in df.collect()}


def test_each_suppression_rule(spark):
    without = lambda k: {x: v for x, v in GOOD.items() if x != k}
    cases = [
        (GOOD, []),
        (GOOD | {"requested_at": "2024-05-01T10:00:00+02:00"}, []),
        *((without(k), [f"missing_{k}"]) for k in GOOD),
        (GOOD | {"reason": None}, ["missing_reason"]),
        (GOOD | {"id": "  "}, ["id"]),
        (GOOD | {"voter_id": "7"}, ["voter_id"]),
        (GOOD | {"voter_id": True}, ["voter_id"]),
        (GOOD | {"voter_id": 7.5}, ["voter_id"]),
        (GOOD | {"action": "hide"}, ["action"]),
        (GOOD | {"action": "unsuppress"}, ["supersedes"]),
        (GOOD | {"action": "unsuppress", "supersedes": " "}, ["supersedes"]),
        (GOOD | {"action": "unsuppress", "supersedes": "s0"}, []),
        (GOOD | {"requested_at": "soon"}, ["requested_at"]),
        (GOOD | {"requested_at": 20240101}, ["requested_at"]),
        (GOOD | {"requested_at": None}, []),
        ("[1]", ["not_a_mapping"]),
        ("{", ["not_a_mapping"]),
        ("7", ["not_a_mapping"]),
        (GOOD | {"action": "hide", "requested_at": "never", "voter_id": "x"}, ["voter_id", "action", "requested_at"]),
    ]
    rows = [("f", i, v if isinstance(v, str) or v.get("id", "s1") != "s1" else v | ({"id": f"s{i}"} if "id" in v else {})) for i, (v, _) in enumerate(cases)]
    assert broken(entries.suppression_entries(lines(spark, *rows))) == {f"f#{i:010d}": want for i, (_, want) in enumerate(cases)}


def test_each_correction_rule(spark):
    cases = [
        (RIGHT, []),
        (RIGHT | {"new_value": None}, []),
        (RIGHT | {"new_value": 2.5}, []),
        *(({x: v for x, v in RIGHT.items() if x != k}, [f"missing_{k}"]) for k in entries.CORRECTION_KEYS),
        (RIGHT | {"meeting_id": "12"}, []),
        (RIGHT | {"meeting_id": "twelve"}, ["meeting_id"]),
        (RIGHT | {"column": "meeting_date"}, ["column"]),
        (RIGHT | {"column": " chair "}, []),
        (RIGHT | {"corrected_at": "2024-13-01"}, ["corrected_at"]),
        (RIGHT | {"corrected_at": "2024-05-01"}, []),
        (RIGHT | {"reason": " ", "corrected_by": ""}, ["reason", "corrected_by"]),
        ("null", ["not_a_mapping"]),
    ]
    rows = [("f", i, v if isinstance(v, str) else v | ({"id": f"c{i}"} if "id" in v else {})) for i, (v, _) in enumerate(cases)]
    got = entries.correction_entries(lines(spark, *rows))
    assert broken(got) == {f"f#{i:010d}": want for i, (_, want) in enumerate(cases)}
    by = {r.correction_id: r for r in got.collect()}
    assert by["c1"].corrected_value is None and by["c2"].corrected_value == "2.5" and by["c8"].meeting_id == 12 and by["c11"].target_column == "chair"


def test_the_first_entry_keeps_an_id(spark):
    say = lambda i: GOOD | {"id": i}
    rows = [("b", 1, say("x")), ("b", 2, say("x")), ("a", 9, say("x")), ("a", 10, say(" x ")), ("b", 3, say("y")), ("c", 1, say("y")), ("c", 2, say("y")), ("c", 3, say("z")), ("c", 4, say("")), ("c", 5, say(""))]
    got = {r.load_seq: (r.violations, r.first_place) for r in entries.suppression_entries(lines(spark, *rows).repartition(4)).collect()}
    place = lambda f, n: f"{f}#{n:010d}"
    assert got == {
        place("a", 9): ([], None),
        place("a", 10): (["repeated_in_file"], place("a", 9)),
        place("b", 1): (["repeated_across_files"], place("a", 9)),
        place("b", 2): (["repeated_in_file"], place("a", 9)),
        place("b", 3): ([], None),
        place("c", 1): (["repeated_across_files"], place("b", 3)),
        place("c", 2): (["repeated_in_file"], place("b", 3)),
        place("c", 3): ([], None),
        place("c", 4): (["id"], None),
        place("c", 5): (["id"], None),
    }
    assert entries.suppression_entries(lines(spark)).count() == 0


def test_strict_names_the_first_fault_by_place(spark):
    rows = [("b", 1, GOOD | {"action": "hide"}), ("a", 2, GOOD | {"id": "q"}), ("a", 3, GOOD | {"id": "q"})]
    with pytest.raises(contracts.ContractError, match=r"a#0000000003: entry 'q' breaks repeated_in_file, first at a#0000000002"):
        entries.strict(entries.suppression_entries(lines(spark, *rows)), "suppression_id")
    fine = entries.strict(entries.suppression_entries(lines(spark, rows[1])), "suppression_id")
    assert "violations" not in fine.columns and fine.count() == 1


def test_lines_keep_their_order_over_blocks(spark, tmp_path):
    """A file of several blocks is read by several tasks; its lines are numbered as written."""
    n = 20000
    (tmp_path / "big.jsonl").write_text("\n".join(json.dumps({"id": f"s{i}", "pad": "x" * 40}) + ("\n" if i % 7 == 0 else "") for i in range(n)) + "\n")
    (tmp_path / "also.jsonl").write_text('{"id": "a"}\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = entries.read_lines(spark, str(tmp_path))
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
        rows = sorted(got.collect(), key=lambda r: (r.source_file, r.load_seq))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 5 and [json.loads(r.value)["id"] for r in rows] == ["a", *(f"s{i}" for i in range(n))]
    assert len({r.load_seq for r in rows}) == n + 1


@pytest.mark.parametrize(
    "raw,want",
    [("2024-05-01", "2024-05-01 00:00:00"), ("2024-05-01T10:30", "2024-05-01 10:30:00"), (" 2024-05-01 10:30:15.25 ", "2024-05-01 10:30:15.25"), ("2024-05-01T10:30:00Z", "2024-05-01 10:30:00"), ("2024-05-01T10:30:00+0200", "2024-05-01 08:30:00"), ("2024-05-01T10:30:00-03:30", "2024-05-01 14:00:00"), ("2024-02-30", None), ("soon", None), ("2024-05", None), ("", None), (None, None)],
)
def test_iso_times(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "x string").select(dates.iso_time(F.col("x")).cast("string")).first()[0]
    assert got == want


def test_ledger_from_files(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text(json.dumps(GOOD | {"requested_at": "2024-05-01"}) + "\n\n" + json.dumps(GOOD | {"id": "s2"}) + "\n")
    rows = entries.strict(entries.suppression_entries(entries.read_lines(spark, str(tmp_path))), "suppression_id").orderBy("load_seq").collect()
    assert [(r.suppression_id, r.voter_id, r.load_seq) for r in rows] == [("s1", 7, "one.jsonl#0000000001"), ("s2", 7, "one.jsonl#0000000003")]
    assert rows[0].requested_at == dt.datetime(2024, 5, 1)
