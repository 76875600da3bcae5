"""Folder-name and file-name parsing, canonical names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: five dotted segments (the fifth may hold dots), an id, a name.
# (?d): only "\n" ends a line.
FOLDER_PATTERN = r"(?d)^([^.]+)\.([^.]+)\.([^.]+)\.([^.]+)\.([^_]+)_([^_]+)_(.+)$"
FOLDER_COLUMNS = (
    "m1", "m2", "m3", "m4", "m5", "citizen_id",
    "person_name_raw", "person_name_display", "unit_code",
)

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip_space(text: Column) -> Column:
    """Remove all Unicode white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def display_name(raw: Column) -> Column:
    return strip_space(F.translate(raw, "_", " "))


def with_folder_parts(df: DataFrame, name: str = "folder_name") -> DataFrame:
    """Add the parsed folder columns and ``folder_valid``; all parts are null on a mismatch."""
    pattern = f"r'{FOLDER_PATTERN}'"
    parts = [
        f"case when folder_valid then regexp_extract({name}, {pattern}, {n}) end as {column}"
        for n, column in enumerate(FOLDER_COLUMNS[:7], start=1)
    ]
    return (
        df.selectExpr("*", f"coalesce({name} rlike {pattern}, false) as folder_valid")
        .selectExpr("*", *parts)
        .withColumns({"person_name_display": display_name(F.col("person_name_raw")), "unit_code": F.col("m1")})
    )


def with_file_parts(df: DataFrame, name: str = "filename") -> DataFrame:
    """Split ``code.slug[.sequence].pdf`` into ``file_code``, ``file_sequence``, ``file_slug``.

    A first part other than two or three ASCII digits leaves all three null. An empty slug
    part leaves the slug null but keeps code and sequence.
    """
    return (
        df.selectExpr(
            "*",
            f"split(case when endswith(lower({name}), '.pdf') then "
            rf"substring({name}, 1, length({name}) - 4) end, r'\.') as _parts",
        )
        .selectExpr(
            "*",
            r"coalesce(size(_parts) >= 2 and get(_parts, 0) rlike r'^[0-9]{2,3}\z', false) as _coded",
            r"coalesce(size(_parts) >= 3 and get(_parts, size(_parts) - 1) rlike r'^[0-9]+\z', false) as _numbered",
        )
        .selectExpr(
            "*",
            "case when _coded then get(_parts, 0) end as file_code",
            "case when _coded and _numbered then try_cast(get(_parts, size(_parts) - 1) as bigint) end as file_sequence",
            "case when _coded then slice(_parts, 2, size(_parts) - if(_numbered, 2, 1)) end as _slug_parts",
        )
        .selectExpr(
            "*",
            "case when not array_contains(_slug_parts, '') then array_join(_slug_parts, '.') end as file_slug",
        )
        .drop("_parts", "_coded", "_numbered", "_slug_parts")
    )


def catalog_slug(filename_base: Column) -> Column:
    """What follows the first dot of the catalog's file-name base."""
    return F.regexp_replace(filename_base, r"^[^.]*\.", "")


def name_status(code: Column, slug: Column, known: Column) -> Column:
    """Parse status of a file name, before readability is considered."""
    return (
        F.when(code.isNull() | slug.isNull(), "MALFORMED_NAME")
        .when(~known, "FILE_NGOAI_TAXONOMY")
        .otherwise("OK")
    )


def folded(text: Column) -> Column:
    """Unicode case folding: texts that differ in case only have one folded form, and sort alike.

    Lower case of upper case is the folded form of all letters but four, which are put right: dotless i folds to itself, both
    sharp s to ss, and no sigma is final.
    """
    kept = F.translate(text, "\u0131", "\ue131")  # a private character stands for dotless i meanwhile
    low = F.lower(F.upper(kept))
    return F.translate(F.replace(low, F.lit("\u00df"), F.lit("ss")), "\u03c2\ue131", "\u03c3\u0131")


def is_canonical(slug: Column, canonical_slug: Column) -> Column:
    return F.coalesce(folded(slug) == folded(canonical_slug), F.lit(False))


def canonical_filename(filename_base: Column, sequence: Column) -> Column:
    """``base.pdf`` without a sequence, ``base.<n>.pdf`` with one (n >= 1)."""
    checked = F.when(sequence >= 1, sequence).otherwise(
        F.raise_error(F.lit("sequence must be >= 1")).cast("bigint")
    )
    return F.when(sequence.isNull(), F.concat(filename_base, F.lit(".pdf"))).otherwise(
        F.concat(filename_base, F.lit("."), checked.cast("string"), F.lit(".pdf"))
    )


def ignored_pattern(patterns: tuple[str, ...]) -> str:
    """One regular expression for names starting with a dot or matching a shell pattern."""
    import fnmatch

    return "|".join([r"^\..*", *("^" + fnmatch.translate(p).replace(r"\Z", r"\z") for p in patterns)])


def is_ignored(relative_path: Column, patterns: tuple[str, ...]) -> Column:
    """True if any path segment is ignored."""
    expression = ignored_pattern(patterns)
    return F.exists(F.split(relative_path, "/"), lambda s: s.rlike(expression))


def stays_inside(relative_path: Column) -> Column:
    """True if a relative path never climbs above its root."""
    steps = F.transform(
        F.split(relative_path, "/"),
        lambda s: F.when(s == "..", -1).when(s.isin("", "."), 0).otherwise(1),
    )
    lowest = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low")),
        lambda acc, s: F.struct(
            (acc["depth"] + s).alias("depth"),
            F.least(acc["low"], acc["depth"] + s).alias("low"),
        ),
    )
    return ~relative_path.startswith("/") & (lowest["low"] >= 0)
