"""Header contracts, row rules, publication guards."""

import pytest
from pyspark.sql import functions as F
from tallyspark import schemas
from tallyspark.operators import contracts
from tallyspark.sources import registry

HEADER = "County_code,Registration_Number,Voter_status,Last_name,First_name,Residence_house_number,Residence_street_name,Residence_street_suffix,Residence_city,Residence_zipcode,Year_of_Birth,Registration_date,Land_district"


@pytest.fixture
def csv(tmp_path):
    def write(header, *lines):
        path = tmp_path / "people.csv"
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    return write


@pytest.mark.parametrize("name", sorted(schemas.CONFIDENTIAL))
def test_confidential_headers_are_refused(name):
    for spelled in (name, name.upper(), name.replace("_", " ").title(), name.replace("_", "-")):
        with pytest.raises(contracts.ContractError, match="confidential"):
            contracts.check_headers(["first_name", spelled])


@pytest.mark.parametrize("name", sorted(schemas.LICENSED))
def test_licensed_headers_are_refused(name):
    contracts.check_headers([name])
    with pytest.raises(contracts.ContractError, match="licensed"):
        contracts.check_headers([name.upper()], licensed=True)


def test_lists():
    assert not schemas.CONFIDENTIAL & schemas.LICENSED and not set(schemas.PUBLIC) & set(schemas.DENIED)
    assert (len(schemas.CONFIDENTIAL), len(schemas.LICENSED), len(schemas.OVERRIDABLE)) == (13, 26, 12)


@pytest.mark.parametrize("raw,want", [("Ward city council_code", "ward_city_council_code"), ("Date-Last-Voted", "date_last_voted"), ("  A  b ", "a_b")])
def test_header_names(raw, want):
    assert contracts.header(raw) == want and contracts.header(want) == want


def test_registry_file(spark, csv):
    path = csv(
        HEADER,
        '60,9000001,A,"O""Neil",Ann,12,Peach,St,ATLANTA,3030,1980,20200131,x',
        "44,9000002,,Bee,Bob,,,,,,,,",
        "999,9000003,I,Cee,Cy,,,,,303031,3000,1/2/2020,",
        "60,zz,Q,Dee,Di,,,,,,,,",
        "60,9000005,A,Eee,Ed,1,2,3,4,5,1990,,x,extra,more",
        "60,9000006,A",
    )
    good, bad = registry.load(spark, path)
    rows = {r.voter_id: r for r in good.collect()}
    assert set(rows) == {9000001, 9000002}
    first = rows[9000001]
    assert (first.last_name, first.residence_zip5, first.county, str(first.registration_date), first.residence_street_name) == ('O"Neil', "03030", "Fulton", "2020-01-31", "Peach St")
    assert rows[9000002].status == "Active" and rows[9000002].county == "DeKalb"
    broken = {r.voter_id: r.violations for r in bad.collect()}
    assert set(broken[9000003]) == {"birth_year", "zip5"} and {"voter_id_number", "status_code", "voter_id", "status"} <= set(broken[None])
    assert "ragged" in broken[9000005] and "ragged" in broken[9000006]
    with pytest.raises(contracts.ContractError):
        registry.load(spark, path, strict=True)


def test_empty_file_and_refused_column(spark, csv):
    with pytest.raises(contracts.ContractError):
        registry.read_csv(spark, csv(""))
    with pytest.raises(contracts.ContractError, match="ssn"):
        registry.read_csv(spark, csv("First_name,SSN", "a,b"))


def test_every_file_of_a_folder_is_checked_and_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Registration_Number,Last_name,First_name,Residence_zipcode\n9000001,Bee,Ann,30303\n")
    (tmp_path / "b.csv").write_text("First_name,Registration_Number,Last_name,Land_district\nBob,9000002,Cee,x\nCy,9000003,Dee\n")
    good, bad = registry.load(spark, str(tmp_path))
    assert {(r.voter_id, r.first_name, r.last_name, r.residence_zip5) for r in good.collect()} == {(9000001, "Ann", "Bee", "30303"), (9000002, "Bob", "Cee", None)}
    assert [(r.voter_id, r.violations) for r in bad.collect()] == [(9000003, ["ragged"])]
    (tmp_path / "c.csv").write_text("Registration_Number,Last_name,SSN,Residence_zipcode\n9000004,Eee,123456789,30303\n")
    with pytest.raises(contracts.ContractError, match="ssn"):
        registry.load(spark, str(tmp_path))
    (tmp_path / "c.csv").write_text("")
    with pytest.raises(contracts.ContractError, match="header"):
        registry.load(spark, str(tmp_path))


def test_ledger_rules_are_broken_one_by_one(spark):
    fine = {"suppression_id": "s1", "voter_id": 1, "action": "suppress", "reason": "r", "requested_by": "b", "supersedes": None}
    breaks = [{}, {"suppression_id": " "}, {"voter_id": None}, {"action": "hide"}, {"action": None}, {"reason": ""}, {"requested_by": None}, {"action": "unsuppress"}, {"action": "unsuppress", "supersedes": "s0"}]
    rows = spark.createDataFrame([(i, *{**fine, **b}.values()) for i, b in enumerate(breaks)], "i int, suppression_id string, voter_id long, action string, reason string, requested_by string, supersedes string")
    got = {r.i: r.violations for r in contracts.checked(rows, contracts.suppression_rules()).collect()}
    assert got == {0: [], 1: ["id"], 2: ["voter_id"], 3: ["action"], 4: ["action"], 5: ["reason"], 6: ["requested_by"], 7: ["supersedes"], 8: []}
    fine = {"correction_id": "c1", "meeting_id": 1, "target_column": "chair", "reason": "r", "corrected_by": "b", "said": "2024-01-01"}
    breaks = [{}, {"correction_id": ""}, {"meeting_id": None}, {"target_column": "meeting_date"}, {"reason": " "}, {"corrected_by": None}, {"said": "soon"}, {"said": None}]
    rows = spark.createDataFrame([(i, *{**fine, **b}.values()) for i, b in enumerate(breaks)], "i int, correction_id string, meeting_id long, target_column string, reason string, corrected_by string, said string").withColumn("corrected_at", F.col("said").try_cast("timestamp"))
    got = {r.i: r.violations for r in contracts.checked(rows, contracts.given_as(contracts.correction_rules(), "said", "corrected_at")).collect()}
    assert got == {0: [], 1: ["id"], 2: ["meeting_id"], 3: ["column"], 4: ["reason"], 5: ["corrected_by"], 6: ["corrected_at"], 7: []}


def test_table_checks(spark):
    rows = [(1, 1900, "30303"), (2, 1899, "30303"), (3, None, "303"), (4, 2100, None), (4, 2000, None), (None, 2000, None)]
    bad = contracts.check_table(spark.createDataFrame(rows, "voter_id long, birth_year int, residence_zip5 string"), "voter.voters", "voter_id")
    assert sorted(((r.voter_id, r.violations) for r in bad.collect()), key=str) == sorted([(2, ["birth_year"]), (3, ["zip5"]), (4, ["repeated"]), (4, ["repeated"]), (None, ["key"])], key=str)
    with pytest.raises(contracts.ContractError):
        contracts.check_table(spark.range(1).withColumn("ssn", F.lit("1")), "voter.voters", "id")


def test_publication():
    assert contracts.publishable("seb.meetings") == "seb.meetings"
    for name in (*schemas.DENIED, "other.table"):
        with pytest.raises(contracts.ContractError):
            contracts.publishable(name)


def test_personal_columns(spark):
    with pytest.raises(contracts.ContractError):
        contracts.no_personal_columns(spark.range(1).withColumn("birth_year", F.lit(1)))


def test_split_valid_without_rows(spark):
    df = spark.createDataFrame([], "voter_id long, first_name string, last_name string, birth_year int, residence_zip5 string, status string")
    good, bad = contracts.split_valid(df, contracts.voter_rules(), strict=True)
    assert good.count() == bad.count() == 0
