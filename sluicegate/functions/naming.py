"""Column expressions over file names, paths, owner names and table names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The naming conventions of landing and archive directories.
CHUNK_NAME = r"^(.+?)_(\d{8})_(\d{8})$"
PLAIN_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
META_SUFFIX = ".meta"
PROCESSED_MARK = "_processed"
PROCESSED_DAY = "yyyyMMdd"

# The name of an archived file: what it was called, the stamp's day and number, ``.meta``.
ARCHIVED_NAME = r"^(.*)(_processed\d{8}(?:-(\d+))?)(\.meta)?$"


def file_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    """A path without its last segment and the slash before it."""
    return F.regexp_replace(path, r"/[^/]*$", "")


def name_kind(name: Column) -> Column:
    """``chunk``, ``plain``, ``meta`` or ``ignored``; only the first two are data files.

    A dotted name is never data, so the chunk and plain tests see undotted names only.
    """
    return (
        F.when(name.endswith(META_SUFFIX), "meta")
        .when(name.contains("."), "ignored")
        .when(name.rlike(CHUNK_NAME), "chunk")
        .when(name.rlike(PLAIN_NAME), "plain")
        .otherwise("ignored")
    )


def table_of(name: Column, kind: Column | None = None) -> Column:
    """Table a landing file belongs to; null for files that are ignored.

    ``kind`` saves working out :func:`name_kind` again where it is a column already.
    """
    kind = name_kind(name) if kind is None else kind
    return (
        F.when(kind == "chunk", F.regexp_extract(name, CHUNK_NAME, 1))
        .when(kind == "plain", name)
        .when(kind == "meta", F.regexp_extract(name, r"^(.*)\.meta$", 1))
    )


def chunk_start(name: Column, kind: Column | None = None) -> Column:
    """First eight-digit group of a chunk name, null for other names."""
    kind = name_kind(name) if kind is None else kind
    return F.when(kind == "chunk", F.regexp_extract(name, CHUNK_NAME, 2))


def chunk_end(name: Column, kind: Column | None = None) -> Column:
    """Second eight-digit group of a chunk name, null for other names."""
    kind = name_kind(name) if kind is None else kind
    return F.when(kind == "chunk", F.regexp_extract(name, CHUNK_NAME, 3))


def archive_name(name: Column, day: Column, number: Column | None = None) -> Column:
    """Name a landing file gets in the archive: the stamp goes last, or before ``.meta``.

    From the second delivery of a day on the stamp ends with the delivery's number.
    """
    stamp = F.concat(F.lit(PROCESSED_MARK), F.date_format(day, PROCESSED_DAY))
    if number is not None:
        stamp = F.concat(stamp, F.when(number > 1, F.concat(F.lit("-"), number)).otherwise(""))
    stem = F.regexp_replace(name, r"\.meta$", "")
    suffix = F.when(name.endswith(META_SUFFIX), META_SUFFIX).otherwise("")
    return F.concat(stem, stamp, suffix)


def owner_of(identity: Column) -> Column:
    """``first.last@host`` or ``first.last`` to ``last``; an undotted name is kept whole."""
    return F.substring_index(F.substring_index(identity, "@", 1), ".", -1)


def owner_prefix(identity: Column) -> Column:
    """Table-name prefix ``last_`` for an identity, empty when nothing usable remains."""
    words = F.btrim(F.regexp_replace(owner_of(identity), "[^a-zA-Z0-9]+", "_"), F.lit("_"))
    return F.when(words == "", "").otherwise(F.concat(words, F.lit("_")))


def qualified_name(schema: Column, prefix: Column, table: Column) -> Column:
    """``schema.[prefix]table``."""
    return F.concat(schema, F.lit("."), prefix, table)
