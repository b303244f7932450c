"""Queries over the driver's tables, each with the SQL that gives its rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import address, dates, text
from ..operators import contracts, entries, files, ledger, limiter, merge, reads, tables, views
from ..sources import feeds, registry
from . import jobs
from .adapters import adapter, with_adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None, *names: str):
    """Register a function of the named adapters, and its SQL over them."""

    def add(f: Callable[..., DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(adapter(spark, sf_dir, n) for n in names))
        if sql:
            SQL[f.__name__] = with_adapters(sql, *names)
        return f

    return add


ACTIVE = """active AS (SELECT voter_id, max_by(suppression_id, requested_at) AS x FROM (
 SELECT *, row_number() OVER (PARTITION BY voter_id ORDER BY requested_at DESC, suppression_id DESC) AS rn FROM suppressions) WHERE rn = 1 AND action = 'suppress' GROUP BY voter_id),
 open_voters AS (SELECT v.* FROM voters v WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.voter_id = v.voter_id))"""
COUNTY = """SELECT county, status, count(*) AS voter_count, count(DISTINCT residence_zip5) AS distinct_zip5_count, CAST(min(birth_year) AS INT) AS earliest_birth_year,
 CAST(max(birth_year) AS INT) AS latest_birth_year FROM open_voters WHERE county IS NOT NULL GROUP BY county, status"""
QUARTER = """SELECT CAST(year(meeting_date) AS INT) AS year, CAST(quarter(meeting_date) AS INT) AS quarter, compliance_status, count(*) AS meeting_count,
 CAST(sum(CASE WHEN quorum_met = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS quorum_met_count,
 CAST(sum(CASE WHEN controversies IS NOT NULL AND trim(controversies) NOT IN ('', 'None') THEN 1 ELSE 0 END) AS BIGINT) AS controversy_meeting_count FROM meetings GROUP BY ALL"""
OVERLAP = f"""WITH {ACTIVE}, people AS ({COUNTY}), quarters AS ({QUARTER}) SELECT year, quarter, county, status AS voter_status, voter_count, distinct_zip5_count,
 compliance_status, meeting_count, quorum_met_count, controversy_meeting_count FROM quarters, people"""


@query(OVERLAP, "meetings", "voters", "suppressions")
def overlap(meetings, voters, suppressions):
    return views.overlap(meetings, voters, suppressions)


@query(OVERLAP + " ORDER BY year DESC, quarter DESC, county NULLS LAST, compliance_status NULLS LAST, voter_status NULLS LAST LIMIT 100 OFFSET 20", "meetings", "voters", "suppressions")
def overlap_page(meetings, voters, suppressions):
    return reads.overlap_page(views.overlap(meetings, voters, suppressions), limit=100, offset=20)


@query(OVERLAP + " WHERE county = 'NATION_7' ORDER BY year DESC, quarter DESC, compliance_status, voter_status LIMIT 50", "meetings", "voters", "suppressions")
def overlap_of_county(meetings, voters, suppressions):
    return reads.overlap_page(views.overlap(meetings, voters, suppressions), county="NATION_7")


@query(OVERLAP + " WHERE compliance_status <> 'Clean' AND status = 'Active'", "meetings", "voters", "suppressions")
def flagged_overlap(meetings, voters, suppressions):
    return views.overlap(meetings, voters, suppressions).filter("compliance_status <> 'Clean' AND voter_status = 'Active'")


@query(
    "SELECT voter_id, suppression_id, action, requested_at FROM (SELECT *, row_number() OVER (PARTITION BY voter_id ORDER BY requested_at DESC, suppression_id DESC) AS rn FROM suppressions) WHERE rn = 1 AND action = 'suppress'",
    "suppressions",
)
def active_suppressions(suppressions):
    return ledger.active_suppressions(suppressions)


@query(f"WITH {ACTIVE} SELECT * FROM open_voters", "voters", "suppressions")
def public_voters(voters, suppressions):
    return views.public_voters(voters, suppressions)


@query(f"WITH {ACTIVE} {COUNTY}", "voters", "suppressions")
def county_summary(voters, suppressions):
    return views.county_summary(views.public_voters(voters, suppressions))


@query(f"WITH {ACTIVE} {COUNTY} ORDER BY county, status LIMIT 30 OFFSET 10", "voters", "suppressions")
def county_page(voters, suppressions):
    return reads.county_page(views.county_summary(views.public_voters(voters, suppressions)), 30, 10)


@query(
    f"""WITH {ACTIVE} SELECT county, precinct, status, CASE WHEN count(*) < 25 THEN NULL ELSE count(*) END AS voter_count, count(*) < 25 AS suppressed_for_size
    FROM open_voters WHERE precinct IS NOT NULL GROUP BY county, precinct, status""",
    "voters",
    "suppressions",
)
def precinct_summary(voters, suppressions):
    return views.precinct_summary(views.public_voters(voters, suppressions))


@query("SELECT county, status, CASE WHEN count(*) < 25 THEN NULL ELSE count(*) END AS voter_count, count(*) < 25 AS suppressed_for_size FROM voters GROUP BY county, status", "voters")
def small_cells(voters):
    return views.suppress_small(voters, ["county", "status"])


@query(QUARTER, "meetings")
def meeting_quarter(meetings):
    return views.meeting_quarter(meetings)


@query("SELECT * FROM meetings ORDER BY meeting_date DESC, meeting_id DESC LIMIT 50 OFFSET 5", "meetings")
def meetings_page(meetings):
    return reads.meetings_page(meetings, 50, 5)


@query("SELECT * FROM meetings WHERE meeting_id = 7", "meetings")
def meeting_by_key(meetings):
    return reads.where(meetings, meeting_id=7)


@query("SELECT * FROM meetings WHERE compliance_status = 'Clean'", "meetings")
def meetings_filtered(meetings):
    return reads.where(meetings, compliance_status="Clean", meeting_type=None)


@query(
    """SELECT m.*, coalesce((SELECT string_agg(video_id, ',' ORDER BY coalesce(published_date, DATE '9999-12-31'), video_id, video_url) FROM videos v WHERE v.meeting_id = m.meeting_id), '') AS videos FROM meetings m""",
    "meetings",
    "videos",
)
def meeting_details(meetings, videos):
    return reads.meeting_detail(meetings, videos)


@query("SELECT count(*) AS meetings, count(video_url) AS with_video, max(meeting_date) AS latest FROM meetings", "meetings")
def meeting_counts(meetings):
    return meetings.agg(F.count("*").alias("meetings"), F.count("video_url").alias("with_video"), F.max("meeting_date").alias("latest"))


@query(
    """WITH one AS (SELECT published_date AS d, min(video_url) AS url FROM (SELECT DISTINCT video_url, published_date FROM videos WHERE meeting_id IS NULL AND published_date IS NOT NULL)
    GROUP BY published_date HAVING count(*) = 1)
    SELECT m.* REPLACE (coalesce(m.video_url, one.url) AS video_url) FROM meetings m LEFT JOIN one ON m.meeting_date = one.d""",
    "meetings",
    "videos",
)
def gap_fill(meetings, videos):
    return merge.fill_video_urls(meetings, videos)


@query(
    """WITH old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY load_seq, quantity) AS r FROM videos WHERE quantity < 25) WHERE r = 1),
    new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY load_seq DESC, quantity DESC) AS r FROM videos WHERE quantity >= 25) WHERE r = 1)
    SELECT video_id, video_url, load_seq, quantity FROM new UNION ALL SELECT video_id, video_url, load_seq, quantity FROM old WHERE video_id NOT IN (SELECT video_id FROM new)""",
    "videos",
)
def merged_videos(videos):
    rows = videos.select("video_id", "video_url", "load_seq", "quantity")
    first = rows.filter("quantity < 25").groupBy("video_id").agg(F.min_by(F.struct("video_url", "load_seq", "quantity"), F.struct("load_seq", "quantity")).alias("v")).select("video_id", "v.*")
    return merge.merge(first, rows.filter("quantity >= 25"), "video_id", "load_seq", "quantity")


LATEST = "SELECT *, row_number() OVER (PARTITION BY meeting_id, target_column ORDER BY corrected_at DESC, correction_id DESC) AS rn FROM corrections"


@query(f"SELECT meeting_id, target_column, correction_id, corrected_value, corrected_by, corrected_at, reason FROM ({LATEST}) WHERE rn = 1", "corrections")
def corrections_latest(corrections):
    return ledger.corrections_latest(corrections)


@query("SELECT * FROM corrections WHERE meeting_id = 10 ORDER BY corrected_at, correction_id", "corrections")
def audit_trail(corrections):
    return reads.audit_trail(corrections, 10)


@query("SELECT *, 1 AS batch FROM suppressions WHERE action = 'suppress' UNION ALL SELECT *, 2 FROM suppressions WHERE action <> 'suppress'", "suppressions")
def ledger_append(suppressions):
    log = suppressions.filter("action = 'suppress'").withColumn("batch", F.lit(1))
    return ledger.append(suppressions.withColumn("batch", F.lit(2)), log, "suppression_id")[0]


@query("SELECT CAST(sum(CASE WHEN action = 'suppress' THEN 0 ELSE 1 END) AS BIGINT) AS logged, CAST(sum(CASE WHEN action = 'suppress' THEN 1 ELSE 0 END) AS BIGINT) AS skipped FROM suppressions", "suppressions")
def ledger_counts(suppressions):
    return ledger.append(suppressions, suppressions.filter("action = 'suppress'"), "suppression_id")[1]


@query("SELECT s.* FROM suppressions s WHERE s.voter_id NOT IN (SELECT voter_id FROM voters WHERE county IS NOT NULL)", "suppressions", "voters")
def unknown_voters(suppressions, voters):
    return ledger.missing(suppressions, "voter_id", voters.filter("county IS NOT NULL"), "voter_id")


@query("SELECT * FROM suppressions WHERE supersedes IS NOT NULL AND supersedes NOT IN (SELECT suppression_id FROM suppressions)", "suppressions")
def unresolved_supersedes(suppressions):
    return ledger.unresolved(suppressions)


@query(
    """SELECT suppression_id, CASE WHEN action = 'unsuppress' AND supersedes IS NULL THEN 'supersedes' ELSE '' END AS broken FROM suppressions""",
    "suppressions",
)
def ledger_violations(suppressions):
    rows = contracts.checked(suppressions, contracts.suppression_rules())
    return rows.select("suppression_id", F.array_join("violations", ",").alias("broken"))


@query("SELECT correction_id, CASE WHEN trim(reason) = '' THEN 'reason' ELSE '' END AS broken FROM corrections", "corrections")
def correction_violations(corrections):
    return contracts.checked(corrections, contracts.correction_rules()).select("correction_id", F.array_join("violations", ",").alias("broken"))


REPEATS = """t AS (SELECT *, first_value(load_seq) OVER (PARTITION BY id ORDER BY source_file, load_seq) AS first, min(load_seq) OVER (PARTITION BY id, source_file) AS first_here FROM {rows}),
 r AS (SELECT *, CASE WHEN load_seq <> first THEN first END AS first_place, CASE WHEN load_seq <> first AND load_seq > first_here THEN 'repeated_in_file' WHEN load_seq <> first THEN 'repeated_across_files' END AS repeat FROM t)"""


@query(
    "WITH known AS (SELECT *, CASE WHEN k IN (10, 11) OR trim(id) = '' THEN 'none' || load_seq ELSE id END AS key FROM raw_suppressions), "
    + REPEATS.format(rows="(SELECT * EXCLUDE (id), key AS id FROM known)")
    + """ SELECT load_seq, CASE WHEN starts_with(id, 'none') THEN '' ELSE id END AS suppression_id, CASE WHEN k IN (0, 1, 2, 10, 11) THEN NULL ELSE user_id END AS voter_id,
    CASE WHEN k NOT IN (6, 10, 11) THEN CAST('2024-05-0' || CAST(1 + e % 9 AS STRING) || ' 10:00:00' AS TIMESTAMP) END AS requested_at, coalesce(first_place, '') AS first_place,
    concat_ws(',', CASE k WHEN 10 THEN 'not_a_mapping' WHEN 11 THEN 'not_a_mapping' WHEN 3 THEN 'missing_reason' WHEN 5 THEN 'id' WHEN 0 THEN 'voter_id' WHEN 1 THEN 'voter_id' WHEN 2 THEN 'voter_id' WHEN 4 THEN 'action' WHEN 7 THEN 'supersedes' WHEN 6 THEN 'requested_at' END, repeat) AS broken FROM r""",
    "raw_suppressions",
)
def suppression_entries(raw):
    rows = entries.suppression_entries(raw.select("value", "source_file", "load_seq"))
    return rows.select("load_seq", "suppression_id", "voter_id", "requested_at", F.coalesce("first_place", F.lit("")).alias("first_place"), F.array_join("violations", ",").alias("broken"))


@query(
    "WITH "
    + REPEATS.format(rows="raw_corrections")
    + """ SELECT load_seq, id AS correction_id, CASE k WHEN 0 THEN NULL WHEN 1 THEN 12 ELSE e END AS meeting_id, CASE k WHEN 8 THEN NULL ELSE 'new' END AS corrected_value,
    CASE WHEN k NOT IN (5, 9) THEN CAST('2024-02-0' || CAST(1 + e % 9 AS STRING) || ' 00:00:00' AS TIMESTAMP) END AS corrected_at, coalesce(first_place, '') AS first_place,
    concat_ws(',', CASE k WHEN 3 THEN 'missing_corrected_by' WHEN 0 THEN 'meeting_id' WHEN 2 THEN 'column' WHEN 4 THEN 'reason' WHEN 5 THEN 'corrected_at' END, repeat) AS broken FROM r""",
    "raw_corrections",
)
def correction_entries(raw):
    rows = entries.correction_entries(raw.select("value", "source_file", "load_seq"))
    return rows.select("load_seq", "correction_id", "meeting_id", "corrected_value", "corrected_at", F.coalesce("first_place", F.lit("")).alias("first_place"), F.array_join("violations", ",").alias("broken"))


#: Overrides one row an id: those logged before, and a batch that holds them again beside new ones, some for meetings that are not there.
BATCHES = """one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY correction_id ORDER BY load_seq) AS nth FROM corrections) WHERE nth = 1),
 held AS (SELECT * FROM meetings WHERE meeting_id % 11 <> 3), log AS (SELECT * FROM one WHERE load_seq % 3 = 0)"""


def _first_of_id(corrections: DataFrame, *within: str) -> DataFrame:
    """One row an id, that of least ``load_seq``.  Rows are dealt by id before they are sorted, so nothing is sorted as it is read.

    Columns that the id decides, given as ``within``, are dealt by instead.
    """
    nth = F.row_number().over(Window.partitionBy(*within, "correction_id").orderBy("load_seq"))
    return corrections.repartition(*(within or ("correction_id",))).withColumn("nth", nth).filter("nth = 1").drop("nth")


def _batches(corrections: DataFrame, meetings: DataFrame) -> DataFrame:
    one = _first_of_id(corrections)
    return ledger.applied(one, one.filter("load_seq % 3 = 0"), meetings.filter("meeting_id % 11 <> 3"))


@query(
    f"""WITH {BATCHES}, fresh AS (SELECT o.* FROM one o JOIN held h ON o.meeting_id = h.meeting_id WHERE o.load_seq % 3 <> 0),
    base AS (SELECT meeting_id, 'chair' AS target_column, chair AS v FROM held UNION ALL SELECT meeting_id, 'quorum_met', quorum_met FROM held UNION ALL SELECT meeting_id, 'hours_logged', CAST(hours_logged AS VARCHAR) FROM held UNION ALL SELECT meeting_id, 'video_url', video_url FROM held),
    last AS (SELECT meeting_id, target_column, CASE WHEN target_column = 'hours_logged' THEN CAST(TRY_CAST(corrected_value AS DOUBLE) AS VARCHAR) ELSE corrected_value END AS v FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id, target_column ORDER BY load_seq DESC, correction_id DESC) AS rn FROM log) WHERE rn = 1),
    now AS (SELECT b.meeting_id, b.target_column, CASE WHEN l.meeting_id IS NULL THEN b.v ELSE l.v END AS v FROM base b LEFT JOIN last l ON b.meeting_id = l.meeting_id AND b.target_column = l.target_column),
    ordered AS (SELECT *, row_number() OVER w AS n, lag(corrected_value) OVER w AS before FROM fresh WINDOW w AS (PARTITION BY meeting_id, target_column ORDER BY load_seq, correction_id))
    SELECT correction_id, o.meeting_id, o.target_column, CASE WHEN n = 1 THEN v ELSE before END AS original_value FROM ordered o JOIN now ON o.meeting_id = now.meeting_id AND o.target_column = now.target_column""",
    "corrections",
    "meetings",
)
def applied_corrections(corrections, meetings):
    """What a batch adds to the ledger: overrides that aren't logged, each with the value in effect before it."""
    return _batches(corrections, meetings).filter("NOT known AND NOT lost").select("correction_id", "meeting_id", "target_column", "original_value")


@query(
    f"""WITH {BATCHES} SELECT count(*) FILTER (WHERE load_seq % 3 <> 0 AND meeting_id IN (SELECT meeting_id FROM held)) AS logged, count(*) FILTER (WHERE load_seq % 3 <> 0 AND meeting_id IN (SELECT meeting_id FROM held)) AS applied,
    count(*) FILTER (WHERE load_seq % 3 = 0) AS skipped, count(*) FILTER (WHERE load_seq % 3 <> 0 AND meeting_id NOT IN (SELECT meeting_id FROM held)) AS lost FROM one""",
    "corrections",
    "meetings",
)
def correction_counts(corrections, meetings):
    """How many overrides of a batch are logged and applied, skipped, and refused."""
    return _batches(corrections, meetings).agg(*(c.alias(n) for n, c in ledger.apply_counts().items()))


@query("SELECT video_id, count(*) AS n FROM videos GROUP BY video_id HAVING count(*) > 1", "videos")
def repeated_keys(videos):
    return contracts.repeated(videos, "video_id")


@query(
    """WITH base AS (SELECT meeting_id, 'chair' AS target_column, chair AS v FROM meetings UNION ALL SELECT meeting_id, 'quorum_met', quorum_met FROM meetings
    UNION ALL SELECT meeting_id, 'hours_logged', CAST(hours_logged AS VARCHAR) FROM meetings UNION ALL SELECT meeting_id, 'video_url', video_url FROM meetings),
    ordered AS (SELECT *, row_number() OVER w AS nth, lag(corrected_value) OVER w AS before FROM corrections WINDOW w AS (PARTITION BY meeting_id, target_column ORDER BY load_seq, correction_id))
    SELECT o.meeting_id, o.target_column, correction_id, CASE WHEN nth = 1 THEN v ELSE before END AS original_value, corrected_value
    FROM ordered o JOIN base b ON o.meeting_id = b.meeting_id AND o.target_column = b.target_column""",
    "corrections",
    "meetings",
)
def override_snapshots(corrections, meetings):
    return ledger.snapshots(corrections, meetings).select("meeting_id", "target_column", "correction_id", "original_value", "corrected_value")


def effective_sql(rows: str) -> str:
    pick = lambda c, cast=None: f"CASE WHEN {c}_o.meeting_id IS NULL THEN m.{c} ELSE {'TRY_CAST(' if cast else ''}{c}_o.corrected_value{f' AS {cast})' if cast else ''} END AS {c}"
    joins = " ".join(f"LEFT JOIN (SELECT * FROM o WHERE target_column = '{c}') {c}_o ON {c}_o.meeting_id = m.meeting_id" for c in ("chair", "quorum_met", "hours_logged", "video_url"))
    return f"""WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id, target_column ORDER BY load_seq DESC, correction_id DESC) AS rn FROM {rows}) WHERE rn = 1)
    SELECT m.meeting_id, m.meeting_date, m.meeting_type, m.compliance_status, m.controversies, {pick("chair")}, {pick("quorum_met")}, {pick("hours_logged", "DOUBLE")}, {pick("video_url")} FROM meetings m {joins}"""


@query(effective_sql("corrections"), "meetings", "corrections")
def effective_meetings(meetings, corrections):
    return ledger.effective(meetings, corrections)


@query(effective_sql("(SELECT * FROM corrections WHERE corrected_at <= TIMESTAMP '1998-01-01 00:00:00')"), "meetings", "corrections")
def meetings_as_of(meetings, corrections):
    return ledger.as_of(meetings, corrections, F.lit("1998-01-01").cast("timestamp"))


@query(
    """WITH asks AS (SELECT row_number() OVER () AS r, * FROM instants),
    o AS (SELECT r, target_column, arg_max(struct_pack(v := corrected_value), struct_pack(a := load_seq, b := correction_id)).v AS v FROM asks a JOIN corrections c ON a.meeting_id = c.meeting_id AND c.corrected_at <= a.asked_at GROUP BY r, target_column),
    w AS (SELECT r, bool_or(target_column = 'chair') AS has_chair, max(CASE WHEN target_column = 'chair' THEN v END) AS chair, bool_or(target_column = 'quorum_met') AS has_quorum, max(CASE WHEN target_column = 'quorum_met' THEN v END) AS quorum,
     bool_or(target_column = 'hours_logged') AS has_hours, max(CASE WHEN target_column = 'hours_logged' THEN v END) AS hours, bool_or(target_column = 'video_url') AS has_url, max(CASE WHEN target_column = 'video_url' THEN v END) AS url FROM o GROUP BY r)
    SELECT asked_id, asked_at, m.meeting_id, CASE WHEN has_chair THEN w.chair ELSE m.chair END AS chair, CASE WHEN has_quorum THEN w.quorum ELSE m.quorum_met END AS quorum_met,
    CASE WHEN has_hours THEN TRY_CAST(w.hours AS DOUBLE) ELSE m.hours_logged END AS hours_logged, CASE WHEN has_url THEN w.url ELSE m.video_url END AS video_url FROM asks a JOIN meetings m ON a.meeting_id = m.meeting_id LEFT JOIN w ON w.r = a.r""",
    "meetings",
    "corrections",
    "instants",
)
def meetings_at_instants(meetings, corrections, instants):
    """Every asked meeting as it stood at the time asked for."""
    return ledger.as_of_each(meetings, corrections, instants, "asked_at").select("asked_id", "asked_at", "meeting_id", "chair", "quorum_met", "hours_logged", "video_url")


@query(
    """SELECT meeting_id, concat_ws(',', CASE WHEN compliance_status NOT IN ('Compliant', 'Notice Concerns', 'Other Concerns', 'Unreviewed') THEN 'compliance_status' END,
    CASE WHEN hours_logged > 24 OR hours_logged < 0 THEN 'hours_logged' END) AS broken FROM meetings""",
    "meetings",
)
def meeting_violations(meetings):
    return contracts.checked(meetings, contracts.meeting_rules()).select("meeting_id", F.array_join("violations", ",").alias("broken"))


REGISTRY = """WITH t AS (SELECT TRY_CAST(nullif(trim(registration_number), '') AS BIGINT) AS voter_id, nullif(trim(registration_number), '') AS id_text, nullif(trim(last_name), '') AS last_name,
 TRY_CAST(nullif(year_of_birth, '') AS INT) AS birth_year, CASE WHEN residence_zipcode = '' THEN NULL WHEN length(residence_zipcode) < 5 THEN lpad(residence_zipcode, 5, '0') ELSE residence_zipcode END AS zip,
 nullif(registration_date, '') AS d, nullif(voter_status, '') AS s, county_code, residence_street_name || coalesce(' ' || nullif(residence_street_suffix, ''), '') AS street FROM raw_registry),
 u AS (SELECT *, CASE WHEN d IN ('20240131', '1/31/2024', '2024-01-31') THEN DATE '2024-01-31' END AS registered,
 CASE coalesce(s, 'A') WHEN 'A' THEN 'Active' WHEN 'I' THEN 'Inactive' WHEN 'P' THEN 'Pending' WHEN 'C' THEN 'Cancelled' END AS status,
 CASE county_code WHEN '60' THEN 'Fulton' WHEN '44' THEN 'DeKalb' WHEN '11' THEN 'Bibb' END AS county FROM t)
 SELECT voter_id, last_name, birth_year, zip AS residence_zip5, street AS residence_street_name, registered AS registration_date, status, county,
 concat_ws(',', CASE WHEN id_text IS NOT NULL AND voter_id IS NULL THEN 'voter_id_number' END, CASE WHEN d IS NOT NULL AND registered IS NULL THEN 'registration_date' END, CASE WHEN s IS NOT NULL AND status IS NULL THEN 'status_code' END,
 CASE WHEN voter_id IS NULL THEN 'voter_id' END, CASE WHEN last_name IS NULL THEN 'last_name' END, CASE WHEN birth_year NOT BETWEEN 1900 AND 2100 THEN 'birth_year' END,
 CASE WHEN length(zip) <> 5 THEN 'zip5' END, CASE WHEN status IS NULL THEN 'status' END) AS broken FROM u"""


@query(REGISTRY, "raw_registry")
def registry_rows(raw):
    return registry.registry_rows(raw).select(
        "voter_id", "last_name", "birth_year", "residence_zip5", "residence_street_name", "registration_date", "status", "county", F.array_join("violations", ",").alias("broken")
    )


@query(
    """WITH t AS (SELECT *, TRY_CAST(nullif(regexp_extract(voterbase_id, '^(?i:TS)?([0-9]+)$', 1), '') AS BIGINT) AS voter_id, nullif(vf_voter_status, '') AS s, nullif(vf_reg_address1, '') AS line FROM raw_vendor)
    SELECT voter_id, CASE coalesce(upper(s), 'ACTIVE') WHEN 'ACTIVE' THEN 'Active' WHEN 'INACTIVE' THEN 'Inactive' WHEN 'PURGED' THEN 'Cancelled' END AS status,
    nullif(regexp_extract(line, '^([0-9]+) +(.+)$', 1), '') AS residence_house_number,
    CASE WHEN regexp_matches(line, '^[0-9]+ +.+$') THEN regexp_extract(line, '^([0-9]+) +(.+)$', 2) ELSE line END AS residence_street_name,
    CASE vf_county_name WHEN 'DEKALB' THEN 'Dekalb' ELSE 'St Clair-Bibb' END AS county FROM t""",
    "raw_vendor",
)
def vendor_rows(raw):
    return registry.vendor_rows(raw).select("voter_id", "status", "residence_house_number", "residence_street_name", "county")


@query(
    """WITH t AS (SELECT *, TRY_CAST(nullif(regexp_extract(voterbase_id, '^(?i:TS)?([0-9]+)$', 1), '') AS BIGINT) AS voter_id, nullif(vf_voter_status, '') AS s FROM raw_vendor),
    u AS (SELECT *, CASE coalesce(upper(s), 'ACTIVE') WHEN 'ACTIVE' THEN 'Active' WHEN 'INACTIVE' THEN 'Inactive' WHEN 'PURGED' THEN 'Cancelled' END AS status FROM t)
    SELECT voterbase_id, voter_id, tsmart_last_name AS last_name, concat_ws(',', CASE WHEN voter_id IS NULL THEN 'vendor_id' END, CASE WHEN s IS NOT NULL AND status IS NULL THEN 'status_label' END, CASE WHEN voter_id IS NULL THEN 'voter_id' END,
    CASE WHEN status IS NULL THEN 'status' END) AS broken FROM u""",
    "raw_vendor",
)
def vendor_violations(raw):
    """Every vendor row with the rules it breaks."""
    rows = registry.vendor_rows(raw.withColumn("tsmart_middle_name", F.col("voterbase_id")))
    return rows.select(F.col("middle_name").alias("voterbase_id"), "voter_id", "last_name", F.array_join("violations", ",").alias("broken"))


@query("SELECT trim(registration_number) AS voter_id, residence_house_number AS house_number, 'PEACH TREE' AS street_name, false AS bad FROM raw_registry WHERE residence_street_suffix <> '' UNION ALL SELECT trim(registration_number), residence_house_number, NULL, true FROM raw_registry WHERE residence_street_suffix = ''", "raw_registry")
def houses_without_street(raw):
    """Addresses of which some lost their street, and whether each is one of those."""
    c = F.col
    street = F.when(c("residence_street_suffix") != "", c("residence_street_name"))
    none = F.lit(None).cast("string")
    people = raw.select(F.trim("registration_number").alias("voter_id"), c("residence_house_number").alias("house_number"), street.alias("street_name"), none.alias("street_suffix"), none.alias("apartment"), none.alias("city"), none.alias("zip5"))
    bad = jobs.standard_addresses(people).select("voter_id", "bad")
    return people.select("voter_id", "house_number", "street_name").join(bad.distinct(), "voter_id").filter((c("street_name").isNull()) == c("bad")).select("voter_id", "house_number", "street_name", "bad")


SHOWN = "meeting_id, meeting_date, day_of_week, meeting_type, meeting_format, chair, members_present, quorum_met, agenda_summary, key_decisions, video_url, source_url, compliance_status, compliance_notes, controversies, hours_logged"


@query(f"SELECT {SHOWN} FROM stored_meetings ORDER BY meeting_date DESC, meeting_id DESC LIMIT 60 OFFSET 40", "stored_meetings")
def meetings_endpoint(stored_meetings):
    """A page of the meetings endpoint: its 16 columns and no others."""
    return reads.projected(reads.meetings_page(stored_meetings, 60, 40), "meetings")


@query("SELECT video_id, video_url, video_id AS title, published_date, CAST(NULL AS VARCHAR) AS description FROM videos WHERE meeting_id = 314", "videos")
def meeting_videos_endpoint(videos):
    """The videos of one meeting as its endpoint shows them."""
    return reads.meeting_videos(videos.withColumns({"title": F.col("video_id"), "description": F.lit(None).cast("string")}), 314)


@query(
    "SELECT meeting_id AS source_id, 's' AS name, CASE meeting_id % 3 WHEN 0 THEN 'Other' WHEN 1 THEN 'News' ELSE 'Other' END AS source_type, CASE meeting_id % 4 WHEN 0 THEN 'https://h.example' WHEN 1 THEN 'https://t.example' ELSE '' END AS url, CASE WHEN meeting_id % 5 = 0 THEN 'n' END AS notes FROM meetings",
    "meetings",
)
def source_sheet_rows(meetings):
    """The sources sheet made of every meeting."""
    k, none = F.col("meeting_id"), F.lit(None).cast("string")
    sheet = meetings.select(
        k.cast("string").alias("number"), F.lit(" s ").alias("name"), F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(" News ")).otherwise(none).alias("type"), F.when(k % 4 == 0, F.lit("https://h.example")).alias("url_href"),
        F.when(k % 4 == 1, F.lit("https://t.example")).when(k % 4 == 2, F.lit("Link")).otherwise(none).alias("url_text"), F.when(k % 5 == 0, F.lit("n")).alias("notes"),
    )
    return feeds.source_sheet(sheet)


@query(
    """WITH t AS (SELECT title_id, title, nullif(regexp_extract(title, '(?i)(January|February|March|April|May|June|July|August|September|October|November|December|Sept|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\\s+(\\d{1,2}),?\\s+(\\d{4})', 0), '') AS l,
    nullif(regexp_extract(title, '\\b(\\d{2})\\.(\\d{2})\\.(\\d{2})\\b', 0), '') AS s FROM titles),
    p AS (SELECT *, CASE lower(left(l, 3)) MONTHS END AS m, regexp_extract(l, '[a-zA-Z]+\\s+(\\d{1,2})', 1) AS d, right(l, 4) AS y FROM t)
    SELECT title_id, coalesce(TRY_CAST(y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS DATE), TRY_CAST('20' || substr(s, 7, 2) || '-' || substr(s, 1, 2) || '-' || substr(s, 4, 2) AS DATE)) AS meeting_date FROM p""".replace("\\\\", "\\").replace("MONTHS", " ".join(f"WHEN '{name}' THEN '{number}'" for name, number in dates.MONTH_NUMBERS.items())),
    "titles",
)
def title_dates(titles):
    return titles.select("title_id", dates.title_date(F.col("title")).alias("meeting_date"))


@query(
    """SELECT residence_city AS raw, CASE nullif(residence_city, '') WHEN 'ATLANTA' THEN 'Atlanta' WHEN 'stand-in  o''brien' THEN 'Stand-In O''Brien' END AS city, residence_street_suffix AS raw_suffix,
    CASE nullif(residence_street_suffix, '') WHEN 'street' THEN 'St' WHEN 'Ave.' THEN 'Ave' WHEN 'RANDOM' THEN 'Random' WHEN 'blvd' THEN 'Blvd' END AS suffix, count(*) AS n FROM raw_registry GROUP BY ALL""",
    "raw_registry",
)
def city_and_suffix(raw):
    c = F.col
    rows = raw.select(c("residence_city").alias("raw"), address.city(c("residence_city")).alias("city"), c("residence_street_suffix").alias("raw_suffix"), address.street_suffix(c("residence_street_suffix")).alias("suffix"))
    return rows.groupBy("raw", "city", "raw_suffix", "suffix").agg(F.count("*").alias("n"))


@query(
    """SELECT CAST(trim(registration_number) AS STRING) AS voter_id, concat_ws(', ', residence_house_number || ' Peach Tree' || coalesce(' ' || CASE residence_street_suffix WHEN 'street' THEN 'St' WHEN 'Ave.' THEN 'Ave' WHEN 'RANDOM' THEN 'Random' WHEN 'blvd' THEN 'Blvd' END, ''),
    nullif(trim(residence_apt_unit_nbr), ''), CASE residence_city WHEN 'ATLANTA' THEN 'Atlanta' WHEN '' THEN NULL ELSE 'Stand-In O''Brien' END, 'GA ' || nullif(residence_zipcode, '')) AS line,
    residence_house_number AS house_number, 'Peach Tree' || CASE residence_street_suffix WHEN 'RANDOM' THEN ' Random' ELSE '' END AS street_name,
    CASE residence_street_suffix WHEN 'street' THEN 'St' WHEN 'Ave.' THEN 'Ave' WHEN 'blvd' THEN 'Blvd' END AS street_suffix, nullif(trim(residence_apt_unit_nbr), '') AS apartment,
    CASE residence_city WHEN 'ATLANTA' THEN 'Atlanta' WHEN '' THEN NULL ELSE 'Stand-In O''Brien' END AS city, nullif(residence_zipcode, '') AS zip5 FROM raw_registry""",
    "raw_registry",
)
def standard_addresses(raw):
    c = F.col
    people = raw.select(
        F.trim("registration_number").alias("voter_id"),
        c("residence_house_number").alias("house_number"),
        text.title_case(c("residence_street_name")).alias("street_name"),
        c("residence_street_suffix").alias("street_suffix"),
        c("residence_apt_unit_nbr").alias("apartment"),
        c("residence_city").alias("city"),
        c("residence_zipcode").alias("zip5"),
    )
    return jobs.standard_addresses(people).drop("bad")


@query("SELECT event_id, left(sha256('salt:' || strftime(ts, '%Y-%m-%d') || '|' || ip), 16) AS ip_hash FROM requests", "requests")
def salted_callers(requests):
    return requests.select("event_id", text.day_salted_hash(F.col("ip"), F.col("ts"), "salt").alias("ip_hash"))


@query(
    """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, count(*) AS requests, CAST(sum(CASE WHEN status = 429 THEN 1 ELSE 0 END) AS BIGINT) AS refused,
    count(DISTINCT CASE WHEN status = 429 THEN ip END) AS refused_callers, CAST(sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS server_errors FROM requests GROUP BY 1""",
    "requests",
)
def request_rollup(requests):
    return limiter.request_rollup(requests)


@query(
    """WITH RECURSIVE e AS (SELECT event_id, ip, epoch_us(ts) AS t FROM requests), starts AS (SELECT ip, min(t) AS s FROM e GROUP BY ip
    UNION ALL SELECT starts.ip, (SELECT min(t) FROM e WHERE e.ip = starts.ip AND e.t >= starts.s + 172800000000) FROM starts WHERE starts.s IS NOT NULL),
    r AS (SELECT e.*, s, row_number() OVER (PARTITION BY e.ip, s ORDER BY t, event_id) AS k FROM e ASOF JOIN (SELECT * FROM starts WHERE s IS NOT NULL) q ON e.ip = q.ip AND e.t >= q.s)
    SELECT event_id, ip, k <= 5 AS allowed, CASE WHEN k <= 5 THEN 0 ELSE greatest(1, CAST(floor(172800 - (t - s) / 1e6) AS BIGINT)) END AS retry_after FROM r""",
    "requests",
)
def limited_requests(requests):
    return limiter.limited(requests, window=172800.0, most=5)


@query(
    "SELECT CAST(meeting_id AS STRING) AS meeting_id, coalesce(CAST(meeting_date AS STRING), '') AS meeting_date, coalesce(video_url, '') AS video_url, coalesce(controversies, '') AS controversies, coalesce(CAST(hours_logged AS STRING), '') AS hours_logged FROM meetings",
    "meetings",
)
def workbook_rows(meetings):
    return feeds.workbook_rows(meetings, ["meeting_id", "meeting_date", "video_url", "controversies", "hours_logged"])


INGEST = """WITH known AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY load_seq DESC, published_date DESC) AS r FROM videos WHERE quantity < 25) WHERE r = 1),
    feed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY load_seq DESC, published_date DESC) AS r FROM videos WHERE quantity >= 25) WHERE r = 1),
    held AS (SELECT * FROM feed UNION ALL SELECT * FROM known WHERE video_id NOT IN (SELECT video_id FROM feed)),
    one AS (SELECT published_date AS d, min(video_url) AS url FROM held WHERE meeting_id IS NULL AND published_date IS NOT NULL GROUP BY published_date HAVING count(DISTINCT video_url) = 1),
    merged AS (SELECT m.* REPLACE (coalesce(m.video_url, one.url) AS video_url, CASE WHEN m.meeting_id % 2 = 0 THEN 'Special' ELSE m.meeting_type END AS meeting_type) FROM meetings m LEFT JOIN one ON m.meeting_date = one.d), """


@query(INGEST + effective_sql("(SELECT * FROM corrections WHERE meeting_id IN (SELECT meeting_id FROM merged))").replace("FROM meetings m", "FROM merged m")[5:], "meetings", "videos", "corrections")
def meetings_ingest(meetings, videos, corrections):
    known = ledger.latest(videos.filter("quantity < 25"), ["video_id"], "load_seq", "published_date").select(videos.columns)
    seed = meetings.filter("meeting_id % 2 = 0").withColumn("meeting_type", F.lit("Special"))
    return jobs.ingest_meetings(meetings, seed, known, videos.filter("quantity >= 25"), corrections, "published_date")[0]


#: What both runs of ``ingest_runs`` hold at their ends.
RUNS = """one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY correction_id ORDER BY load_seq) AS nth FROM corrections) WHERE nth = 1),
    held AS (SELECT *, meeting_id % 2 = 0 AS first FROM meetings WHERE meeting_id % 2 = 0 OR meeting_id % 5 <> 4),
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY load_seq DESC, published_date DESC) AS r FROM videos) WHERE r = 1),
    gap AS (SELECT published_date AS d, min(video_url) AS url FROM last WHERE meeting_id IS NULL AND published_date IS NOT NULL GROUP BY published_date HAVING count(DISTINCT video_url) = 1),
    c1 AS (SELECT * FROM one WHERE load_seq % 3 = 0 AND meeting_id IN (SELECT meeting_id FROM held WHERE first)), c2 AS (SELECT * FROM one WHERE meeting_id IN (SELECT meeting_id FROM held)),
    n AS (SELECT (SELECT count(*) FROM c1) AS c1, (SELECT count(*) FROM c2) AS c2)"""


@query(
    f"""WITH {RUNS} SELECT 1 AS run, (SELECT count(*) FROM held WHERE first) AS meetings, (SELECT count(*) FROM meetings WHERE meeting_id % 5 <> 4) AS controversies, (SELECT count(*) FROM meetings WHERE meeting_id % 5 <> 4) AS sources,
    0 AS videos_upserted, (SELECT count(*) FROM held WHERE first) AS meetings_with_video_url, c1 AS logged, c1 AS applied, 0 AS skipped FROM n UNION ALL
    SELECT 2, (SELECT count(*) FROM meetings WHERE meeting_id % 5 <> 4), (SELECT count(*) FROM meetings WHERE meeting_id % 5 <> 4), (SELECT count(*) FROM meetings WHERE meeting_id % 5 <> 4),
    (SELECT count(*) FROM videos), (SELECT count(coalesce(video_url, gap.url)) FROM held LEFT JOIN gap ON held.meeting_date = gap.d), c2 - c1, c2 - c1, c1 FROM n""",
    "meetings",
    "videos",
    "corrections",
)
def ingest_runs(meetings, videos, corrections):
    """The summaries of two runs of the ingest that writes: a seed with corrections, then another seed with a feed and the corrections again."""
    spark, c, k, none = meetings.sparkSession, F.col, F.col("meeting_id"), F.lit(None).cast("string")
    meetings = meetings.withColumns({"hours_logged": c("hours_logged") % 25, "day_of_week": F.lit("Mon"), "meeting_format": F.lit("Zoom"), "members_present": F.lit("all")})
    topics = meetings.filter(k % 5 != 4)
    more = {
        "seb.controversies": topics.select(k.alias("controversy_id"), F.lit("topic").alias("title"), F.lit(None).cast("date").alias("first_seen_date"), F.lit("Active").alias("status"), none.alias("description"), none.alias("latest_action"), none.alias("primary_source")),
        "seb.sources": topics.select(k.alias("source_id"), F.lit("s").alias("name"), F.lit("Other").alias("source_type"), F.lit("u").alias("url"), none.alias("notes")),
    }
    # An id holds its meeting and what load_seq is made of, so rows are dealt by meeting, as the meetings are.
    one, third = (_first_of_id(rows, "meeting_id") for rows in (corrections, corrections.filter("load_seq % 3 = 0")))
    even, known = meetings.filter(k % 2 == 0), meetings.filter((k % 2 == 0) | (k % 5 != 4))
    store = tables.Store(spark, f"{files.shared_folder(spark)}/ingest-{uuid.uuid4().hex}", buckets=16)
    try:
        runs = [
            jobs.ingest(store, {"seb.meetings": even, **more}, None, third.join(even.select("meeting_id"), "meeting_id", "left_semi"), datetime(2024, 1, 1)),
            jobs.ingest(store, {"seb.meetings": topics, **more}, videos.withColumns({"meeting_id": k - k % 2, "title": c("video_id")}), one.join(known.select("meeting_id"), "meeting_id", "left_semi"), datetime(2024, 2, 1), tie="published_date"),
        ]
    finally:
        store.files.delete(store.root)
    rows = [(n, *(run["seed"][x] for x in ("meetings", "controversies", "sources")), run["videos_upserted"], run["meetings_with_video_url"], *(run["corrections"][x] for x in ("logged", "applied", "skipped"))) for n, run in enumerate(runs, 1)]
    return spark.createDataFrame(rows, "run int, meetings long, controversies long, sources long, videos_upserted long, meetings_with_video_url long, logged long, applied long, skipped long")


SEEDED = """seeds AS (SELECT meeting_id AS k, 'topic ' || CAST(meeting_id % 40 AS STRING) AS title, CASE meeting_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'Resolved' ELSE NULL END AS status FROM meetings WHERE meeting_id % 5 <> 4)"""


@query(
    f"WITH {SEEDED} " + "SELECT m.k AS controversy_id, title, CASE WHEN coalesce(status, '') = '' THEN 'Active' ELSE status END AS status FROM (SELECT * FROM seeds) m UNION ALL SELECT meeting_id, 'old', 'Monitoring' FROM meetings WHERE meeting_id % 5 = 4",
    "meetings",
)
def controversies_ingest(meetings):
    return _ingest_all(meetings)[0]["controversies"].select("controversy_id", "title", "status")


@query(
    """SELECT count(CASE WHEN meeting_id % 2 = 0 THEN 1 END) AS seeded_meetings, count(CASE WHEN meeting_id % 5 <> 4 THEN 1 END) AS seeded_controversies, count(CASE WHEN meeting_id % 5 <> 4 THEN 1 END) AS seeded_sources,
    0 AS videos_upserted, count(CASE WHEN meeting_id % 2 = 0 THEN 1 END) AS meetings_with_video, 0 AS corrections_applied FROM meetings""",
    "meetings",
)
def ingest_summary(meetings):
    return _ingest_all(meetings)[1]


def _ingest_all(meetings: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """All four tables from sheets made of every meeting, without a feed."""
    c, k = F.col, F.col("meeting_id")
    cell = k.cast("string")
    of = lambda *v: F.when(k % 3 == 0, v[0]).when(k % 3 == 1, v[1]).otherwise(v[2])
    rows = meetings.filter(k % 5 != 4)
    none = F.lit(None).cast("string")
    controversies = feeds.controversy_sheet(rows.select(cell.alias("number"), F.concat(F.lit(" topic "), (k % 40).cast("string")).alias("title"), none.alias("first_seen"), of("", "Resolved", None).alias("status"), none.alias("description"), none.alias("latest_action"), none.alias("source_href"), none.alias("source_text")))
    sources = feeds.source_sheet(rows.select(cell.alias("number"), F.lit("s").alias("name"), none.alias("type"), none.alias("url_href"), F.lit("https://s.example").alias("url_text"), none.alias("notes")))
    old = meetings.select(k.alias("controversy_id"), F.lit("old").alias("title"), F.lit("Monitoring").alias("status"))
    for name in ("first_seen_date", "description", "latest_action", "primary_source"):
        old = old.withColumn(name, F.lit(None).cast(controversies.schema[name].dataType))
    tables = {"meetings": meetings, "videos": meetings.select(cell.alias("video_id"), k, c("video_url"), F.col("meeting_date").alias("published_date"), k.alias("load_seq")), "controversies": old.select(controversies.columns), "sources": sources.filter("source_id % 2 = 0")}
    corrections = meetings.limit(0).select(cell.alias("correction_id"), k, F.lit("chair").alias("target_column"), c("chair").alias("corrected_value"), k.alias("load_seq"))
    return jobs.ingest_all(tables, {"meetings": meetings.filter(k % 2 == 0), "controversies": controversies, "sources": sources}, None, corrections)


@query(
    """SELECT voter_id, array_to_string(list_filter([CASE WHEN birth_year + 40 * (voter_id % 5) NOT BETWEEN 1900 AND 2100 THEN 'birth_year' END, CASE WHEN voter_id % 9 = 0 THEN 'zip5' END], lambda x: x IS NOT NULL), ',') AS broken
    FROM voters WHERE birth_year + 40 * (voter_id % 5) NOT BETWEEN 1900 AND 2100 OR voter_id % 9 = 0""",
    "voters",
)
def table_violations(voters):
    """The table checks over people of whom some are given a year or ZIP that no table may hold."""
    k = F.col("voter_id")
    rows = voters.withColumn("birth_year", F.col("birth_year") + 40 * (k % 5)).withColumn("residence_zip5", F.when(k % 9 == 0, F.lit("303")).otherwise(F.lit("30303")))
    return contracts.check_table(rows, "voter.voters", "voter_id").select("voter_id", F.array_join("violations", ",").alias("broken"))


@query(
    """SELECT meeting_id, concat_ws(',', CASE WHEN meeting_id % 4 = 3 THEN 'meeting_type' END, CASE WHEN meeting_id % 3 = 2 THEN 'compliance_status' END, CASE WHEN meeting_id % 29 > 24 AND meeting_id % 7 <> 0 THEN 'hours_logged' END, CASE WHEN meeting_id % 7 = 0 THEN 'hours_given' END) AS broken FROM meetings""",
    "meetings",
)
def sheet_violations(meetings):
    """All columns of the meetings sheet, with cells that break the rules."""
    k, none = F.col("meeting_id"), F.lit(None).cast("string")
    hours = F.when(k % 7 == 0, F.lit("long")).otherwise((k % 29).cast("string"))
    cells = {"number": k.cast("string"), "date": F.col("meeting_date").cast("string"), "day": F.lit(" Monday"), "type": F.when(k % 4 == 3, F.lit("Party")).otherwise(F.lit("Regular")), "format": F.lit("Zoom"), "chair": F.col("chair"), "members": F.lit(" all "), "quorum": F.col("quorum_met")}
    cells |= {"agenda": none, "decisions": none, "video_href": F.col("video_url"), "video_text": F.lit("Watch"), "source_href": none, "source_text": F.lit("Source"), "compliance": F.when(k % 3 == 2, F.lit("Fine")).otherwise(none), "notes": none, "hours": hours}
    sheet = meetings.select(*(v.alias(n) for n, v in cells.items()), "controversies")
    rows = feeds.meeting_sheet(sheet).join(sheet.select(F.col("number").cast("long").alias("meeting_id"), F.col("hours").alias("hours_text")), "meeting_id")
    rules = contracts.sheet_rules() | {"hours_given": text.not_a(F.col("hours_text"), F.col("hours_logged"))}
    return contracts.checked(rows, rules).select("meeting_id", F.array_join("violations", ",").alias("broken"))


@query(
    """SELECT title_id, coalesce(nullif(CASE WHEN title_id % 3 = 0 THEN 'https://a.example' END, ''), CASE WHEN title_id % 3 = 1 THEN 'http://b.example' END) AS link, CASE WHEN title IS NULL THEN '' ELSE left(trim(title), 3) END AS day,
    CASE title_id % 3 WHEN 0 THEN DATE '2024-05-01' WHEN 1 THEN DATE '2024-06-15' END AS day_of, CASE WHEN title_id % 3 = 0 THEN 'Unreviewed' ELSE 'Compliant' END AS compliance, CASE title_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 2.5 END AS hours FROM titles""",
    "titles",
)
def sheet_cells(titles):
    k = F.col("title_id") % 3
    of = lambda *v: F.when(k == 0, v[0]).when(k == 1, v[1]).otherwise(v[2])
    return titles.select(
        "title_id",
        text.link(of("https://a.example", "", None), of("Watch", " http://b.example ", "Link")).alias("link"),
        text.day_name(F.col("title")).alias("day"),
        dates.loose_date(of("2024-05", "2024-06-15", "soon")).alias("day_of"),
        feeds.compliance(of(" ", "Compliant", "Compliant")).alias("compliance"),
        text.blank_to_null(of("", "2.5", "x")).try_cast("double").alias("hours"),
    )
