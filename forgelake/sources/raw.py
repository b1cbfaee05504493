"""The raw event archive (gzip JSON lines, one object per event).

The schema is explicit, so no inference job runs and a missing field is a
typed NULL.  PERMISSIVE mode turns a broken line into an all-NULL row (it is
then dropped by the bot split, whose rule is NULL for a NULL login) and a bad
nested value into a NULL field.

Beyond the fields the source pipeline reads, ``payload.pull_request`` also
declares ``additions`` / ``deletions`` / ``changed_files`` (present in older
archive payloads).  When they are absent the staging LOC columns are NULL,
which is the source pipeline's behaviour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Column that keeps a line (or the line of a bad value) as it was, for :func:`read_raw` with ``corrupt``.
CORRUPT = "_corrupt_record"

# --- fixed values: the archive's record ---
_REPO_REF = "struct<id: bigint, name: string, url: string>"
_BRANCH = f"struct<ref: string, sha: string, repo: {_REPO_REF}>"

RAW_EVENT_DDL = (
    "id string, type string, created_at string, "
    "actor struct<id: bigint, login: string, display_login: string>, "
    "repo struct<id: bigint, name: string>, "
    "payload struct<push_id: bigint, before: string, head: string, ref: string, action: string, "
    f"pull_request: struct<id: bigint, number: bigint, url: string, base: {_BRANCH}, head: {_BRANCH}, "
    "additions: bigint, deletions: bigint, changed_files: bigint>>"
)
# ------------------------------------------


def raw_event_schema() -> T.StructType:
    return T.StructType.fromDDL(RAW_EVENT_DDL)


def month_glob(base: str, year: int, month: int, pattern: str = "*json.gz") -> str:
    """Archive layout ``<base>/YYYY-MM/<files>``; any other glob also works with :func:`read_raw`."""
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1..12, got {month}")
    return f"{base.rstrip('/')}/{year:04d}-{month:02d}/{pattern}"


def read_raw(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, *, corrupt: bool = False
) -> DataFrame:
    """Lazy scan of raw JSON lines; with ``corrupt`` the lines that don't parse are kept in :data:`CORRUPT`.

    gzip is not splittable, so scan parallelism equals the file count; the
    staging job writes one Parquet base right after this scan so the JSON is
    parsed exactly once.
    """
    schema = schema or raw_event_schema()
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(paths)
