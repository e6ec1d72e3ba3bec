"""Built-in configuration of the education-platform dataset.

Every literal in this module is a fixed value: identifiers, limits, weights, patterns and
texts that a run must reproduce for its score to be comparable with earlier scores.
"""

from __future__ import annotations

from gaugeframe.config import GateSettings, load_root_causes, load_rules, load_vocabulary

_ROOT_CAUSES = {
    "checks": {
        "users_district_id_not_null": {
            "probable_cause": "Upstream export omitted district join",
            "recommended_fix": "Add district_id to export template and enforce ingestion join",
        },
        "users_email_not_null": {
            "probable_cause": "CRM export allows blank email when contact is incomplete",
            "recommended_fix": "Add validation on source and require email before export",
        },
        "events_event_ts_not_null": {
            "probable_cause": "Event ingestion misses timestamp column from source system",
            "recommended_fix": "Align ingestion mapping and backfill missing event_ts",
        },
    }
}

# dimension -> (id, table, column or columns, rule, warning, fail, severity, weight, description,
# and for column sweeps the pattern of column names)
_CHECKS = {
    "completeness": [
        ("users_email_not_null", "users", "email", "NULL_PERCENTAGE", 0.02, 0.05, 3, 1.5,
         "Email must be populated for every CRM contact."),
        ("events_event_ts_not_null", "events", "event_ts", "NULL_PERCENTAGE", 0.01, 0.03, 4, 1.2,
         "Every interaction must record an event timestamp."),
        ("users_state_not_null", "users", "state", "NULL_PERCENTAGE", 0.01, 0.03, 3, 1.0,
         "Users must have an associated state code."),
        ("users_district_id_not_null", "users", "district_id", "NULL_PERCENTAGE", 0.10, 0.25, 2, 0.7,
         "Each user record should land inside a district reference."),
        ("events_resource_id_not_null", "events", "resource_id", "NULL_PERCENTAGE", 0.005, 0.01, 4, 1.2,
         "Event rows need to reference a resource."),
        ("resources_resource_id_not_null", "resources", "resource_id", "NULL_PERCENTAGE", 0.001, 0.01, 3, 0.8,
         "Resource catalog entries must carry their identifier."),
    ],
    "validity_accuracy": [
        ("users_email_format", "users", "email", r"PATTERN(^[^\s@]+@[^\s@]+\.[^\s@]+$)", 0.01, 0.03, 3, 1.5,
         "CRM emails should match a reasonable email pattern."),
        ("users_state_valid", "users", "state", "PATTERN(^[A-Z]{2}$)", 0.01, 0.03, 3, 1.0,
         "State codes for users must follow the USPS standard."),
        ("districts_state_valid", "districts", "state", "PATTERN(^[A-Z]{2}$)", 0.01, 0.03, 2, 0.8,
         "District states must use the USPS 2-letter codes."),
        ("events_event_ts_date_range", "events", "event_ts", "DATE_RANGE(1900-01-01T00:00:00Z, now)", 0.01, 0.03, 3, 1.1,
         "Event timestamps must stay inside plausible calendar bounds."),
        ("newsletter_subscribed_at_date_range", "newsletter", "subscribed_at", "DATE_RANGE(2000-01-01T00:00:00Z, now)", 0.01, 0.05, 2, 0.7,
         "Newsletter subscription times should fit within the historical window."),
        ("newsletter_opened_at_date_range", "newsletter", "opened_at", "DATE_RANGE(2000-01-01T00:00:00Z, now)", 0.01, 0.05, 2, 0.6,
         "Newsletter opened timestamps must not be in the future."),
        ("newsletter_clicked_at_date_range", "newsletter", "clicked_at", "DATE_RANGE(2000-01-01T00:00:00Z, now)", 0.01, 0.05, 2, 0.6,
         "Newsletter click timestamps must stay within the plausible window."),
        ("numeric_counts_non_negative", "*", None, "NON_NEGATIVE_COUNTS", 0.0, 0.0, 3, 1.2,
         "Count-style numeric columns must never go negative.", "(?i).*count.*"),
    ],
    "consistency": [
        ("newsletter_timestamps_order", "newsletter", ["subscribed_at", "opened_at", "clicked_at"], "TIMESTAMP_ORDER", 0.05, 0.1, 2, 0.9,
         "Tracking timestamps should progress monotonically from subscribe to click."),
        ("resource_grade_band_values", "resources", "grade_band", "ENUM(PreK-2,3-5,6-8,9-12)", 0.1, 0.2, 2, 0.7,
         "Grade-band values should match the configured taxonomy."),
        ("resources_type_normalized", "resources", "type", "ENUM(lesson,assessment,activity,module,pathway)", 0.01, 0.03, 2, 0.8,
         "Resource types must use the canonical lower-case categories."),
        ("users_role_normalized", "users", "role", "ENUM(student,teacher,admin,district_admin,other)", 0.01, 0.03, 2, 0.8,
         "User roles must stay within the allowed normalized set."),
        ("districts_name_to_id_unique", "districts", None, "UNIQUE_MAPPING(district_name, district_id)", 0.001, 0.005, 3, 1.0,
         "Each district name should map to a single district_id after canonicalization."),
    ],
    "uniqueness": [
        ("users_email_unique", "users", "email", "DUPLICATE_PERCENTAGE", 0.005, 0.02, 4, 1.3,
         "Email should uniquely identify CRM records."),
        ("events_pk_unique", "events", "event_id", "DUPLICATE_PERCENTAGE", 0.001, 0.005, 5, 1.8,
         "Each event_id must be unique to avoid lost history."),
        ("resources_resource_id_unique", "resources", "resource_id", "DUPLICATE_PERCENTAGE", 0.001, 0.005, 4, 1.3,
         "Resource IDs must stay unique inside the catalog."),
        ("users_user_id_unique", "users", "user_id", "DUPLICATE_PERCENTAGE", 0.001, 0.002, 5, 1.4,
         "User identifiers must never collide."),
        ("users_email_org_unique", "users", ["email", "org_id"], "DUPLICATE_PERCENTAGE", 0.005, 0.02, 3, 1.1,
         "The (email, org) compound key should dedupe duplicates."),
    ],
    "integrity": [
        ("events_user_fk", "events", "user_id", "FK(users.user_id)", 0.01, 0.03, 5, 2.0,
         "Events must reference an existing user record."),
        ("events_resource_fk", "events", "resource_id", "FK(resources.resource_id)", 0.01, 0.03, 5, 1.8,
         "Resources referenced in events must exist in the master catalog."),
        ("users_district_fk", "users", "district_id", "FK(districts.district_id)", 0.01, 0.05, 4, 1.2,
         "Users must belong to a referenceable district."),
    ],
}

_VOCABULARY = {
    "grade_bands": {
        "PreK-2": {"synonyms": ["prek-2", "k-2", "grades pre k to 2"]},
        "3-5": {"synonyms": ["grades 3-5", "third to fifth"]},
        "6-8": {"synonyms": ["grades 6-8", "middle school"]},
        "9-12": {"synonyms": ["grades 9-12", "high school"]},
    },
    "state_codes": {
        "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "CA": "California", "NY": "New York",
    },
    "district_overrides": {"NYC": "NYC Public Schools"},
}

EXPECTED_SCHEMA = {
    "users": {
        "user_id": "uuid", "email": "email", "org_id": "uuid", "role": "enum",
        "state": "state_code", "district_id": "uuid",
    },
    "resources": {
        "resource_id": "uuid", "type": "enum", "subject": "string", "grade_band": "string",
    },
    "events": {
        "event_id": "uuid", "user_id": "uuid", "resource_id": "uuid", "event_type": "enum",
        "event_ts": "timestamp",
    },
    "newsletter": {
        "email": "email", "subscribed_at": "timestamp", "opened_at": "timestamp",
        "clicked_at": "timestamp",
    },
    "districts": {"district_id": "uuid", "district_name": "string", "state": "state_code"},
}

GATE = GateSettings(score_threshold=90.0, critical_severity=5.0)


def _entry(row: tuple) -> dict:
    check_id, table, columns, rule, warning, fail, severity, weight, description, *regex = row
    columns = [columns] if isinstance(columns, str) else columns
    return {
        "id": check_id,
        "table": table,
        "columns": columns,
        "rule": rule,
        "threshold": {"warning": warning, "fail": fail},
        "severity": severity,
        "weight": weight,
        "description": description,
        "column_regex": regex[0] if regex else None,
    }


RULES = load_rules(
    {
        "checks": {dim: [_entry(row) for row in rows] for dim, rows in _CHECKS.items()},
        "score": {"baseline": 100, "min": 0},
    },
    load_root_causes(_ROOT_CAUSES),
)
VOCABULARY = load_vocabulary(_VOCABULARY)
