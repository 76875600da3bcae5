"""Planning imports of new documents: checks, names, renames, provenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook import schema
from casebook.functions.names import canonical_filename
from casebook.functions.text import allowed_upload, valid_rotation
from casebook.operators.spread import prefix_fold
from casebook.sources.catalog import with_catalog

# Fixed value: an upload session token.
TOKEN_PATTERN = r"^[0-9a-f]{32}\z"


def existing_numbers(documents: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per case and type, the names taken in the case folder itself: the highest sequence
    number (null if none) and whether the plain name exists."""
    in_folder = documents.filter(
        F.col("is_present") & (F.col("relative_path") == F.concat_ws("/", "case_key", "filename"))
    ).select("case_key", "filename", F.substring_index("filename", ".", 1).alias("_prefix"))
    base = F.col("filename_base")
    tail = F.expr("substring(filename, length(filename_base) + 1)")
    types = F.broadcast(
        catalog.select("code", "filename_base", F.substring_index("filename_base", ".", 1).alias("_prefix"))
    )
    named = (
        in_folder.join(types, "_prefix")
        .filter(F.col("filename").startswith(base))
        .withColumn("_tail", tail)
        .filter(F.col("_tail").rlike(r"^(\.[0-9]+)?\.pdf\z"))
    )
    number = F.regexp_extract("_tail", r"^\.([0-9]+)\.pdf", 1)
    return named.groupBy("case_key", "code").agg(
        F.max(F.nullif(number, F.lit("")).try_cast("bigint")).alias("max_sequence"),
        F.bool_or(F.col("_tail") == ".pdf").alias("plain_exists"),
    )


def with_planned(documents: DataFrame, events: DataFrame) -> DataFrame:
    """What ``existing_numbers`` needs of documents, and the names that earlier batches gave and no scan has seen yet."""
    # paths are put together where they are compared, so that no row travels with its path and its parts
    path = F.concat_ws("/", "case_key", "filename")
    planned, stored = events.select("case_key", "filename").distinct(), documents.select(F.col("relative_path").alias("_path"))
    unseen = planned.join(stored, path == F.col("_path"), "left_anti").select(
        path.alias("relative_path"), "case_key", "filename", F.lit(True).alias("is_present")
    )
    return documents.select(unseen.columns).unionByName(unseen)


def assign_sequences(
    requests: DataFrame,
    existing: DataFrame,
    catalog: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """Name every request; those for one case and type are numbered in request order.

    Numbered names exist: continue after the highest. Only the plain name exists (or was just
    given to an earlier request): the new document is number 2 and the plain one becomes
    number 1 (``rename_from``, ``rename_to``). Neither exists: the plain name.
    """
    asked = requests.select(
        "token",
        "case_key",
        F.col("type_id").alias("code"),
        "requested_at",
        F.lit(1).alias("_one"),
    )
    taken = existing.select(
        "case_key",
        "code",
        F.lit("").alias("token"),
        F.lit(0).alias("_one"),
        F.struct("max_sequence", "plain_exists").alias("_taken"),
    )
    ranked = prefix_fold(
        asked.unionByName(taken, allowMissingColumns=True),
        ["case_key", "code"],
        ["_one", "requested_at", "token"],  # stored names come first
        sums={"_rank": F.col("_one")},
        lasts={"_names": F.col("_taken")},
        keep=keep,
    ).filter("_one = 1")

    top, rank = F.col("_names.max_sequence"), F.col("_rank")
    plain = F.coalesce("_names.plain_exists", F.lit(False))
    sequence = (
        F.when(top.isNotNull(), top + 1 + rank).when(plain, rank + 2).when(rank > 0, rank + 1)
    )
    renamed = top.isNull() & F.when(plain, rank == 0).otherwise(rank == 1)
    base = F.col("catalog_base")
    return (
        with_catalog(ranked, catalog, "code")
        .withColumn("sequence", sequence.cast("bigint"))
        .select(
            "token",
            "case_key",
            F.col("code").alias("type_id"),
            "sequence",
            canonical_filename(base, F.col("sequence")).alias("filename"),
            F.when(renamed, F.concat(base, F.lit(".pdf"))).alias("rename_from"),
            F.when(renamed, F.concat(base, F.lit(".1.pdf"))).alias("rename_to"),
        )
    )


def next_filename(existing: DataFrame, catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """The name one new document would get, for (case_key, code) pairs."""
    base = F.col("catalog_base")
    top = F.col("max_sequence")
    sequence = F.when(top.isNotNull(), top + 1).when(F.col("plain_exists"), 2).cast("bigint")
    return with_catalog(wanted.join(existing, ["case_key", "code"], "left"), catalog, "code").select(
        "case_key",
        "code",
        canonical_filename(base, sequence).alias("filename"),
        F.when(top.isNull() & F.col("plain_exists"), F.concat(base, F.lit(".1.pdf"))).alias("plain_becomes"),
    )


def page_list_problem(ids: Column, known: Column) -> Column:
    """True if a page list is empty, repeats a page or names an unknown one."""
    return (
        ids.isNull()
        | (F.size(ids) == 0)
        | (F.size(ids) != F.size(F.array_distinct(ids)))
        | (F.size(F.array_except(ids, known)) > 0)
    )


def page_list_checks(requested: DataFrame, known: DataFrame) -> DataFrame:
    """The same check on long tables: (``request``, ``page_id``) rows against known pages.

    Each page is counted first, so a request of any length is checked by partial aggregates.
    """
    per_page = requested.groupBy("request", "page_id").agg(F.count("*").alias("n"))
    matched = per_page.join(
        known.select("request", "page_id").distinct().withColumn("_known", F.lit(True)),
        ["request", "page_id"],
        "left",
    )
    return matched.groupBy("request").agg(
        F.sum("n").alias("pages"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(F.col("_known").isNull()).alias("unknown"),
    ).withColumn("valid", (F.col("repeated") == 0) & (F.col("unknown") == 0))


def _by_name(entries: Column, key: str, value: str) -> Column:
    """A map from an array of structs; the last entry of a key wins.

    Entries are numbered and sorted by key, so the last of a key stands before another key: no entry is compared with
    all others.
    """
    numbered = F.array_sort(F.transform(entries, lambda e, n: F.struct(e[key].alias("k"), n.alias("n"), e[value].alias("v"))))
    last = F.filter(
        numbered, lambda e, n: e["k"].isNotNull() & ~F.get(numbered, n + 1)["k"].eqNullSafe(e["k"])
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))


# Extensions of sources that have pages of their own, and of those that are one page.
_PAGED = ".pdf"


def _base_name(name: Column) -> Column:
    """Last component of a path as written by a client; empty for none."""
    last = F.regexp_extract(F.coalesce(name, F.lit("")), r"([^/]*)/*$", 1)
    return F.when(last == ".", "").otherwise(last)


def named_uploads(uploads: DataFrame) -> DataFrame:
    """Uploaded files (``token``, ``case_key``, ``position``, ``name``, ``sha256``, ``page_count``) with the name they are stored
    under, their number of pages and what is wrong with them (``problem``, null if nothing).

    ``page_count`` counts for PDFs only: null if the file can't be read.
    """
    own = uploads.withColumn("name", _base_name(F.col("name")))
    extension = F.lower(F.regexp_extract("name", r"[^/](\.[^./]+)$", 1))
    paged = extension == _PAGED
    problem = (
        F.when(~allowed_upload(F.col("name")), "file type not allowed")
        .when(paged & F.col("page_count").isNull(), "unreadable PDF")
        .when(paged & (F.col("page_count") < 1), "PDF without pages")
    )
    number = F.col("position").cast("string")
    stored = F.concat(F.lit("source-"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number), extension)
    return own.withColumns(
        {"stored": stored, "paged": paged, "n_pages": F.when(paged, F.col("page_count")).otherwise(1).cast("bigint"), "problem": problem}
    )


def judge_uploads(sessions: DataFrame, named: DataFrame) -> DataFrame:
    """``token``, ``case_key`` and ``reason`` (null if accepted) of every upload session: what is wrong with its first bad file,
    or that nothing is left. One bad file refuses the whole session.

    Pages are summed by hashing; only bad files, whose texts have to be sorted, are looked at by position. ``named`` is
    read for each: keep it first.
    """
    pages = named.groupBy("token").agg(F.sum("n_pages").alias("_pages"))
    bad = named.filter("problem is not null").groupBy("token").agg(
        F.min_by("problem", "position").alias("_problem"), F.min_by("name", "position").alias("file")
    )
    nothing = F.when(F.coalesce("_pages", F.lit(0)) < 1, "nothing to upload")
    return sessions.select("token", "case_key").join(pages, "token", "left").join(bad, "token", "left").select(
        "token", "case_key", F.coalesce("_problem", nothing).alias("reason"), F.when(F.col("_problem").isNotNull(), F.col("file")).alias("file")
    )


def upload_pages(
    named: DataFrame, judged: DataFrame, keep: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """The offered pages of accepted sessions, numbered over all sources of a session in upload order.

    How many pages come before a source is a running sum over the session, of which only one range is ever sorted in a
    task; pages are then unfolded from each source by itself.
    """
    accepted = named.join(judged.filter("reason is null").select("token"), "token", "left_semi")
    sized = accepted.select("token", "case_key", "position", "name", "stored", "paged", "n_pages")
    placed = prefix_fold(sized, ["token"], ["position"], {"_before": F.col("n_pages")}, {}, keep)
    each = placed.withColumn("_page", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_pages"))))
    page_id = F.concat(F.lit("p"), (F.col("_before") + F.col("_page")).cast("string"))
    return each.select(
        "token",
        "case_key",
        (F.col("_before") + F.col("_page")).cast("bigint").alias("number"),
        page_id.alias("page_id"),
        F.col("name").alias("source_name"),
        F.col("stored").alias("source_path"),
        F.when(F.col("paged"), F.col("_page")).cast("int").alias("source_page"),
        F.concat(page_id, F.lit(".png")).alias("preview_name"),
    )


def manifests_of_uploads(named: DataFrame, pages: DataFrame) -> DataFrame:
    """Manifests (``token``, ``case_key``, ``sources``, ``pages``) as ``judge_requests`` and the manifest files have them: one row
    holds one session, as one file does."""
    page = F.struct("number", "page_id", "source_name", "source_path", "source_page", "preview_name")
    offered = pages.groupBy("token", "case_key").agg(F.sort_array(F.collect_list(page)).alias("_pages"))
    source = F.struct("position", "name", "stored", "sha256")
    sources = named.join(offered.select("token"), "token", "left_semi").groupBy("token").agg(F.sort_array(F.collect_list(source)).alias("_sources"))
    bare = lambda name, first: F.transform(name, lambda x: x.dropFields(first))
    return offered.join(sources, "token").select("token", "case_key", bare("_sources", "position").alias("sources"), bare("_pages", "number").alias("pages"))


def check_requests(requests: DataFrame, manifests: DataFrame, cases: DataFrame, catalog: DataFrame) -> DataFrame:
    """The different requests with their number of ``_copies``, a digest (``_request``) and what is wrong with each by itself
    (``_reason``, null if nothing).

    Of a manifest only what is judged by travels: the case, the page ids and whether a source is of a wrong type.
    """
    m = manifests.select(
        "token",
        F.col("case_key").alias("_m_case"),
        F.transform("pages", lambda p: p["page_id"]).alias("_offered"),
        F.exists("sources", lambda s: ~allowed_upload(s["name"])).alias("_bad_source"),
    )
    known_cases = cases.filter("is_present").select("case_key", F.lit(True).alias("_case_known"))
    # equal requests are judged once
    distinct = requests.groupBy(*requests.columns).agg(F.count("*").alias("_copies"))
    joined = distinct.join(known_cases, "case_key", "left").join(m, "token", "left")
    reason = (
        F.when(~F.col("catalog_known"), "invalid type code")
        .when(~F.col("token").rlike(TOKEN_PATTERN) | F.col("_offered").isNull(), "unreadable session")
        .when(~F.col("_m_case").eqNullSafe(F.col("case_key")), "session of another case")
        .when(page_list_problem(F.transform("pages", lambda p: p["id"]), F.col("_offered")), "invalid page list")
        .when(F.col("_case_known").isNull(), "unknown case")
        .when(F.exists("pages", lambda p: ~valid_rotation(p["rotation"])), "invalid rotation")
        .when(F.col("_bad_source"), "source type not allowed")
        .when(F.col("requested_at").isNull(), "no request time")
    )
    return with_catalog(joined, catalog, "type_id").select(
        *requests.columns, "_copies", F.xxhash64(*requests.columns).alias("_request"), reason.alias("_reason")
    )


def use_sessions(checked: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Checked requests, each copy by itself, with a ``reason`` (null if accepted). It reads ``checked`` twice: keep that first.

    A session is used up by its first request that is fine, or by an earlier batch. Both are found by one partial
    aggregate, so any number of requests may name one session, or none.
    """
    order = F.struct("requested_at", "case_key", "type_id", "_request")
    first = checked.filter("_reason is null").select("token", order.alias("_first"), F.lit(False).alias("_spent"))
    if events is not None:
        spent = events.select("token", F.lit(None).cast(first.schema["_first"].dataType).alias("_first"), F.lit(True).alias("_spent"))
        first = first.unionByName(spent)
    used_by = first.groupBy("token").agg(F.min("_first").alias("_first"), F.max("_spent").alias("_spent"))
    joined = checked.join(used_by.withColumnRenamed("token", "_token"), F.col("token") == F.col("_token"), "left")
    each = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    used = F.when(
        F.col("_reason").isNull() & (F.col("_spent") | (F.col("_first") < order) | (F.col("_copy") > 1)), "session already used"
    )
    return each.withColumn("reason", F.coalesce("_reason", used)).drop("_copies", "_request", "_reason", "_token", "_first", "_spent", "_copy")


def judge_requests(
    requests: DataFrame,
    manifests: DataFrame,
    cases: DataFrame,
    catalog: DataFrame,
    events: DataFrame | None = None,
) -> DataFrame:
    """Requests with a ``reason`` (null if accepted).

    ``events``: the stored provenance; a session of which it holds a row is used up.
    """
    return use_sessions(check_requests(requests, manifests, cases, catalog), events)


def renames(named: DataFrame) -> DataFrame:
    """Plain names that become number 1."""
    return named.filter("rename_from is not null").select("case_key", "type_id", "rename_from", "rename_to")


def provenance_rows(accepted: DataFrame, manifests: DataFrame, named: DataFrame, at: Column) -> DataFrame:
    """One row per new document: its source files in page order and their digests.

    Page lists stay inside their request row; nothing is exploded or collected.
    """
    listed = (
        accepted.join(named.select("token", "filename"), "token")
        .join(manifests.select("token", F.col("sources").alias("_sources"), F.col("pages").alias("_pages")), "token")
        .withColumns(
            {
                "_by_page": _by_name(F.col("_pages"), "page_id", "source_name"),
                "_digests": _by_name(F.col("_sources"), "name", "sha256"),
            }
        )
        .withColumn("source_files", F.transform("pages", lambda p: F.try_element_at("_by_page", p["id"])))
        .withColumn(
            "source_sha256",
            F.map_from_entries(
                F.transform(
                    F.array_distinct("source_files"),
                    lambda n: F.struct(n, F.coalesce(F.try_element_at("_digests", n), F.lit(""))),
                )
            ),
        )
    )
    rows = listed.withColumns(
        {
            "document_date": F.nullif("document_date", F.lit("")),
            "note": F.nullif("note", F.lit("")),
            "created_at": at,
        }
    )
    return schema.conform(rows, "import_events")
