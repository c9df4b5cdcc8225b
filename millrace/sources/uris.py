"""Storage addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mount prefix of the object store and the scheme of its addresses.
MOUNT_PREFIX = "/minio/"
SCHEME = "s3://"


def object_path(path: Column) -> Column:
    """The path without the mount prefix or leading slashes."""
    return F.when(path.startswith(MOUNT_PREFIX), F.substring(path, len(MOUNT_PREFIX) + 1, 1 << 30)).otherwise(
        F.regexp_replace(path, "^/+", "")
    )


def storage_uri(path: Column) -> Column:
    return F.concat(F.lit(SCHEME), object_path(path))


def bucket_of(path: Column) -> Column:
    return F.get(F.split(object_path(path), "/", 2), 0)


def key_of(path: Column) -> Column:
    return F.coalesce(F.get(F.split(object_path(path), "/", 2), 1), F.lit(""))
