"""Fixed values of the data model: names, enums, code tables, allow-lists."""

from __future__ import annotations

# Headers that must never be read.
CONFIDENTIAL = frozenset(
    "birth_month birth_day birth_date date_of_birth dob ssn social_security_number dl_number drivers_license drivers_license_number email email_address registration_location".split()
)
LICENSED = frozenset(
    (
        "voterbase_age voterbase_dob voterbase_race voterbase_gender voterbase_phone voterbase_phone_presence_flag voterbase_phone_wireless_flag "
        "voterbase_email voterbase_email_presence_flag tsmart_partisan_score tsmart_presidential_general_turnout_score tsmart_midterm_general_turnout_score "
        "tsmart_local_voter_score tsmart_path_to_progressive_score tsmart_trump_resistance_score reg_latitude reg_longitude tsmart_latitude tsmart_longitude "
        "tsmart_full_address tsmart_address1 tsmart_address2 tsmart_city tsmart_state tsmart_zip tsmart_zip4"
    ).split()
)

# File header to field.
REGISTRY_FIELDS = {
    "registration_number": "voter_id",
    "first_name": "first_name",
    "middle_maiden_name": "middle_name",
    "last_name": "last_name",
    "name_suffix": "name_suffix",
    "year_of_birth": "birth_year",
    "residence_house_number": "residence_house_number",
    "residence_street_name": "residence_street_name",
    "residence_apt_unit_nbr": "residence_apartment",
    "residence_city": "residence_city",
    "residence_zipcode": "residence_zip5",
    "race": "race",
    "gender": "gender",
    "registration_date": "registration_date",
    "date_last_voted": "last_voted_date",
    "voter_status": "status_code",
    "county_code": "county_code",
    "county_precinct_id": "precinct",
    "residence_street_suffix": "street_suffix",
}
VENDOR_FIELDS = {
    "voterbase_id": "vendor_id",
    "tsmart_first_name": "first_name",
    "tsmart_middle_name": "middle_name",
    "tsmart_last_name": "last_name",
    "vf_reg_address1": "address_line",
    "vf_reg_address2": "residence_apartment",
    "vf_reg_city": "residence_city",
    "vf_reg_zip": "residence_zip5",
    "vf_county_name": "county",
    "vf_precinct_name": "precinct",
    "vf_voter_status": "status_label",
}

# Code tables.
STATUS_CODES = {"A": "Active", "I": "Inactive", "P": "Pending", "C": "Cancelled"}
STATUS_LABELS = {"ACTIVE": "Active", "INACTIVE": "Inactive", "PENDING": "Pending", "PURGED": "Cancelled", "CANCELLED": "Cancelled"}
COUNTY_CODES = {"11": "Bibb", "25": "Chatham", "29": "Clarke", "44": "DeKalb", "60": "Fulton", "106": "Muscogee", "121": "Richmond"}

# Enums.
VOTER_STATUSES = ("Active", "Inactive", "Pending", "Cancelled")
MEETING_TYPES = ("Regular", "Regular (Day 1)", "Regular (Day 2)", "Special Called", "Emergency", "Executive Session")
COMPLIANCE = ("Compliant", "Notice Concerns", "Other Concerns", "Unreviewed")
ACTIONS = ("suppress", "unsuppress")

# Columns of a meeting that an override may change.
OVERRIDABLE = (
    "video_url",
    "source_url",
    "meeting_format",
    "chair",
    "members_present",
    "quorum_met",
    "agenda_summary",
    "key_decisions",
    "compliance_status",
    "compliance_notes",
    "controversies",
    "hours_logged",
)

# The tables, and the columns beside the key that must not be null in them.
REQUIRED = {
    "seb.meetings": "meeting_date day_of_week meeting_type meeting_format chair members_present quorum_met compliance_status".split(),
    "seb.videos": "video_url title".split(),
    "seb.controversies": "title status".split(),
    "seb.sources": "name source_type url".split(),
    "seb.meeting_corrections": "meeting_id target_column reason corrected_by corrected_at".split(),
    "voter.voters": "first_name last_name status".split(),
    "voter.suppressions": "voter_id action reason requested_by requested_at".split(),
}

# What may be published, what never, and columns that never leave.
PUBLIC = ("analytics.seb_voter_overlap", "seb.controversies", "seb.meetings", "seb.sources", "seb.videos", "voter.county_registration_summary")
DENIED = ("voter.voters", "voter.suppressions", "voter.active_suppressions", "voter.precinct_registration_summary", "seb.meeting_corrections")
EXPORTED = {"seb.meetings": "seb_meetings", "voter.county_registration_summary": "voter_county_registration", "analytics.seb_voter_overlap": "seb_voter_overlap"}
PERSONAL = frozenset(
    "voter_id first_name last_name middle_name residence_zip5 residence_house_number residence_street_name residence_apartment residence_city birth_year precinct".split()
)

# What each endpoint shows, in order.
PROJECTIONS = {
    "meetings": (
        "meeting_id meeting_date day_of_week meeting_type meeting_format chair members_present quorum_met agenda_summary key_decisions "
        "video_url source_url compliance_status compliance_notes controversies hours_logged"
    ).split(),
    "meeting_videos": "video_id video_url title published_date description".split(),
    "county_registration": "county status voter_count distinct_zip5_count earliest_birth_year latest_birth_year".split(),
}

VOTER_COLUMNS = (
    "voter_id first_name middle_name last_name name_suffix birth_year residence_house_number residence_street_name residence_apartment "
    "residence_city residence_zip5 race gender registration_date last_voted_date status county precinct"
).split()
VIDEO = "video_id string, meeting_id long, video_url string, title string, published_date date, description string"
CORRECTION = "id string, meeting_id long, column string, new_value string, reason string, evidence_url string, corrected_by string, corrected_at timestamp"
SUPPRESSION = "id string, voter_id long, action string, reason string, requested_by string, supersedes string, requested_at timestamp"
REQUEST = "event string, level string, timestamp timestamp, route string, method string, status int, latency_ms double, ip_hash string, response_bytes long"
