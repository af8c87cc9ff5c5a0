"""Secrets in texts, told from copied examples by who holds them across the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import text_of, written

# fixed values: the kinds in their order, and their patterns; letters of the names in either case
KINDS = ("assign", "access", "hex", "owned")
NAMES = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
ASSIGN = rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of 32 or more among those of any length
# runs that may be a key of a kind without a pattern of its own: they mix cases and digits
MIXED = r"[A-Za-z0-9_-]{20,}"
MIXED_HAS = ("[A-Z]", "[a-z]", "[0-9]")
MAX_OWNERS = 2  # a value that more owners hold is a widely copied example
MAX_REPOSITORIES = 20  # and so is one that more repositories hold, be they of one owner


def _matches(text: Column, kind: int, pattern: str, value_group: int, good) -> Column:
    """All leftmost non-overlapping matches as structs (kind, at, gap, width, good, value).

    gap: characters between the previous match and this one; with ``width`` they give the
    places by a running sum, as the text between matches is what ``split`` returns.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"), whole.alias("whole"), values.alias("value")
    )
    found = F.transform(
        F.slice(parts, F.lit(1), F.size(whole)),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("at"),
            F.length(x["before"]).alias("gap"),
            F.length(x["whole"]).alias("width"),
            good(x["whole"], x["value"]).alias("good"),
            F.unhex(F.sha2(x["value"], 256)).alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), found)


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str) -> DataFrame:
    """One row per document, numbered, with the matches of all kinds; texts are read here only."""
    text = F.col("_text")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"),
        text_of(text_col).alias("_text"),
    )
    mixed = [lambda w, v, p=p: w.rlike(p) for p in MIXED_HAS]
    kinds = [
        _matches(text, 0, ASSIGN, 2, lambda w, v: F.length(v) >= 8),
        _matches(text, 1, ACCESS, 0, lambda w, v: F.length(w) >= 16),
        _matches(text, 2, HEX, 0, lambda w, v: F.lit(True)),
        _matches(text, 3, MIXED, 0, lambda w, v: mixed[0](w, v) & mixed[1](w, v) & mixed[2](w, v)),
    ]
    names = ["_assign", "_access", "_hex", "_mixed"]
    rows = rows.withColumns(dict(zip(names, kinds)))
    # kinds with no match that counts need no places
    useful = [F.when(F.exists(F.col(n), lambda m: m["good"]), F.col(n)) for n in names]
    empty = F.array().cast(rows.schema["_assign"].dataType)
    matches = F.concat(*[F.coalesce(u, empty) for u in useful])
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repository", matches.alias("matches"))


def places(found: DataFrame) -> DataFrame:
    """Rows (row, owner, repository, kind, start, end, value) of the matches that count."""
    each = found.select("row", "owner", "repository", F.explode("matches").alias("m")).select("row", "owner", "repository", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = each.withColumn("end", F.sum(F.col("gap") + F.col("width")).over(so_far))
    return ends.where("good").selectExpr(
        "row", "owner", "repository", "kind", "end - width AS start", "end", "value"
    )


def ownership(spans: DataFrame) -> DataFrame:
    """Rows (value, n_owners, n_repositories): who holds each value, over the whole corpus.

    Two steps of grouping, so that a value that very many documents hold is combined before
    each shuffle and no task keeps a list of its holders. A repository belongs to one
    owner; unknown owners are one owner.
    """
    held = spans.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories")
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Rows (id, spans) for every document: an array of (start, kind, end, live), in order.

    The three base kinds are always returned. Their values, and those of runs that mix
    digits and both cases, are counted by distinct owners and repositories over all documents;
    ``live`` tells values that at most ``max_owners`` owners hold in at most ``max_repositories``
    repositories from widely copied examples: many holders of either kind make one. A
    mixed run that is live and overlaps no base span is returned as kind ``owned``.
    Places count code points, ends exclusive. Only digests of the values are moved. Null texts
    are empty; empty texts have no spans; repeated rows are scanned each and counted as one holder.
    Only the four columns named are read, so others may have any name. A text of any length is
    one row, searched whole; its matches are one array until they are numbered.
    """
    found = written(candidates(docs, id_col, text_col, owner_col, repository_col), "secret-candidates")
    spans = written(places(found), "secret-places")
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    known = written(ownership(spans).withColumn("live", few), "secret-owners")
    marked = spans.join(known.select("value", "live").hint("merge"), "value")
    marked = marked.where("kind < 3 OR live").select("row", F.struct("start", "kind", "end", "live").alias("span"))
    listed = marked.groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    kept = F.filter(
        "spans",
        lambda s: (s["kind"] < 3)
        | ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    listed = listed.withColumn("spans", kept)
    rows = found.select("row", "id").join(listed, "row", "left")
    none = F.array().cast(listed.schema["spans"].dataType)
    return rows.select("id", F.coalesce("spans", none).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
