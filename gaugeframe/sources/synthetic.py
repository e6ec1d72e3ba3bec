"""Seeded dirty datasets with planted faults, generated by Spark (IO12).

Identifiers are name-based UUIDs (version 5) computed as column expressions, so the same
dataset name and seed give the same ids wherever a row is generated. `copies` scales the
dataset: every template row appears once per copy, with keys and addresses of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.sources.exports import write_run_metadata

# Fixed values from here on: the id namespace and the template rows of the reference dataset.
NAMESPACE = "3c2f0d46-5df0-4c88-9a5d-dcbf6f3d43e9"

ORGANISATIONS = {
    "Mastery Labs": "org-mastery",
    "NYC Elevate": "org-nyc",
    "Northside Alliance": "org-northside",
    "Sunrise Initiative": "org-sunrise",
}
# key, name, state
DISTRICTS = (
    ("nyc", "NYC", " ny "),
    ("northside", "  northside unified", "Ca"),
    ("northside", "Northside Unified", "CA"),
    ("southvalley", "South Valley", "Texas"),
    ("sunrise", "Sunrise Charter", " CAX "),
)
# key, email, organisation, role, state, district
USERS = (
    ("alice", "  Alice.Smith@Example.com ", "Mastery Labs", "teacher", "ca", "northside"),
    ("bob", "bob@example.COM", "NYC Elevate", "district_admin", "NY", "nyc"),
    ("carol", "", "Northside Alliance", "student", "California", "northside"),
    ("dax", " Dax@Learning.org  ", "Mastery Labs", "teacher", "tx", "southvalley"),
    ("eve", "EVE.lem@Example.com", "Sunrise Initiative", "other", " cax ", None),
    ("frank", " frank@example.com", "Sunrise Initiative", "admin", "zz", "southvalley"),
    ("glenda", "GLENDA@Example.Com", "NYC Elevate", "teacher", "nyc", "nyc"),
    ("alice_alt", "ALICE.Smith@example.com", "Mastery Labs", "teacher", "ca", "northside"),
)
# key, type, subject, grade band
RESOURCES = (
    ("math-fundamentals", "lesson", "  Math ", "grades pre k to 2"),
    ("capstone-think", "Assessment", "ELA", "Grades 3-5"),
    ("science-explorers", "ACTIVITY", " science", "Grades 6-8 "),
    ("pathway-start", "module ", "Social Studies", "High School"),
    ("math-fundamentals", "lesson", "math", "PreK-2"),
    ("missing-resource", "module", "Unknown", "9-12"),
)
# key, user, resource, event type, time
EVENTS = (
    ("evt-view", "alice", "math-fundamentals", " view ", "2024-01-15 14:30:00"),
    ("evt-start", "bob", "capstone-think", "Start", "01/06/2024 08:00:00"),
    ("evt-start-repeat", "bob", "capstone-think", "start", "01/06/2024 08:00 AM"),
    ("evt-complete", "carol", "science-explorers", "complete", "March 3 2024 16:35"),
    ("evt-orphan", "glenda", "missing-resource", "submit", "2024-03-05T09:15:00+00:00"),
    ("evt-share", "frank", "pathway-start", "share", "04/02/2024 13:20"),
)
# email, subscribed, opened, clicked
NEWSLETTER = (
    ("  Alice.Smith@Example.com", "2024-01-01T09:00:00Z", "2024-01-02 10:00 AM", ""),
    ("bob@example.com", "1/5/2024 08:00", "2024-01-06T09:30:00+00:00", "Jan 7 2024 10:00"),
    ("", "2024-01-08 11:11:11", "", ""),
    ("bob@example.com", "2024-01-05 08:00:00", "2024-01-06 09:30", "2024-01-07 10:00"),
)
# End of the fixed values.


def name_uuid(key: Column, namespace: str = NAMESPACE) -> Column:
    """A version 5 UUID of a text, equal to the standard library's `uuid.uuid5`."""
    space = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(space, F.encode(key, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def stable_id(kind: str, identifier: Column, dataset_name: str, seed: int) -> Column:
    return name_uuid(F.concat(F.lit(f"{dataset_name}-{seed}-{kind}-"), identifier))


def _templates(
    spark: SparkSession, rows: Sequence[Sequence[str | None]], names: Sequence[str], copies: int
) -> DataFrame:
    """Every template row once per copy; `_suffix` is empty in the first copy."""
    structs = F.array(
        *[
            F.struct(
                F.lit(i).alias("_row"),
                *[F.lit(v).cast("string").alias(n) for n, v in zip(names, row)],
            )
            for i, row in enumerate(rows)
        ]
    )
    suffix = F.when(F.col("id") == 0, "").otherwise(F.concat(F.lit("-"), F.col("id")))
    return spark.range(copies).select(suffix.alias("_suffix"), F.inline(structs))


def _own(name: str) -> Column:
    return F.concat(F.col(name), F.col("_suffix"))


def _own_email(name: str) -> Column:
    """Copies get addresses of their own; blank addresses stay blank."""
    tagged = F.regexp_replace(name, "@", F.concat(F.col("_suffix"), F.lit("@")))
    return F.when(F.col("_suffix") == "", F.col(name)).otherwise(tagged)


def _shuffled(df: DataFrame, seed: int) -> DataFrame:
    """Seeded row order."""
    place = F.xxhash64(F.lit(seed), F.col("_suffix"), F.col("_row"))
    return df.orderBy(place, "_suffix", "_row").drop("_suffix", "_row")


def generate(
    spark: SparkSession, dataset_name: str, seed: int, copies: int = 1
) -> dict[str, DataFrame]:
    """The five raw tables."""

    def ident(kind: str, key: Column) -> Column:
        return stable_id(kind, key, dataset_name, seed)

    districts = _templates(spark, DISTRICTS, ("key", "name", "state"), copies).select(
        "_suffix", "_row",
        ident("district", _own("key")).alias("district_id"),
        F.when(F.col("_suffix") == "", F.col("name")).otherwise(_own("name")).alias("district_name"),
        "state",
    )
    orgs = F.create_map(*[F.lit(t) for pair in ORGANISATIONS.items() for t in pair])
    users = _templates(
        spark, USERS, ("key", "email", "org", "role", "state", "district"), copies
    ).select(
        "_suffix", "_row",
        ident("user", _own("key")).alias("user_id"),
        _own_email("email").alias("email"),
        ident("org", F.try_element_at(orgs, F.col("org"))).alias("org_id"),
        "role", "state",
        F.coalesce(ident("district", _own("district")), F.lit("")).alias("district_id"),
    )
    resources = _templates(
        spark, RESOURCES, ("key", "type", "subject", "grade_band"), copies
    ).select(
        "_suffix", "_row",
        ident("resource", _own("key")).alias("resource_id"),
        "type", "subject", "grade_band",
    )
    events = _templates(
        spark, EVENTS, ("key", "user", "resource", "event_type", "event_ts"), copies
    ).select(
        "_suffix", "_row",
        ident("event", _own("key")).alias("event_id"),
        ident("user", _own("user")).alias("user_id"),
        ident("resource", _own("resource")).alias("resource_id"),
        "event_type", "event_ts",
    )
    newsletter = _templates(
        spark, NEWSLETTER, ("email", "subscribed_at", "opened_at", "clicked_at"), copies
    ).select(
        "_suffix", "_row", _own_email("email").alias("email"),
        "subscribed_at", "opened_at", "clicked_at",
    )
    raw = {
        "districts": districts, "users": users, "resources": resources, "events": events,
        "newsletter": newsletter,
    }
    return {name: _shuffled(df, seed) for name, df in raw.items()}


def run_metadata(dataset_name: str, seed: int) -> dict[str, object]:
    key = f"{dataset_name}-{seed}-run-{seed}"
    return {
        "dataset_name": dataset_name,
        "seed": seed,
        "run_id": str(uuid.uuid5(uuid.UUID(NAMESPACE), key)),
        "generated_at": datetime.now(timezone.utc).isoformat(),
    }


def write_dataset(
    raw: Mapping[str, DataFrame], folder: str, metadata: Mapping[str, object], force: bool = False
) -> None:
    """CSV exports, one folder per table, and their metadata."""
    mode = "overwrite" if force else "errorifexists"
    for name, df in raw.items():
        df.fillna("").write.mode(mode).csv(
            f"{folder}/{name}.csv", header=True, escape='"', emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    write_run_metadata(next(iter(raw.values())).sparkSession, folder, metadata, force)
