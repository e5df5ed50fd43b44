"""Secret scans: credentials in texts, told from copied examples by who holds them corpus-wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.storage import cut

# Owners from which on a value counts as widely copied.
WIDE = 3
# Shortest value that is looked up where nothing announces it, and its distinct characters.
BARE = 16
VARIED = 8
# Matches of a text whose places are added up together.
BLOCK = 256

KINDS = ("assign", "access", "hex", "bare")


def either_case(pattern: str) -> str:
    """Letters as classes of both cases; engines differ in what else folds to a letter."""
    return "".join(f"[{c.upper()}{c}]" if c.islower() else c for c in pattern)


# The words before a secret, and the characters of values.
NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = f"({NAMES})[\"']?\\x20*[:=]\\x20*[\"']?({VALUE}+)"
ASSIGN_LEAST = 8
# Runs of at least so many characters: a shorter run can hold no longer match.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
RUN = f"{VALUE}{{{BARE},}}"

SPANS = "array<struct<kind: int, start: int, end: int, value: string>>"


def sums_before(sizes: Column) -> Column:
    """For each number of an array the sum of those before it, block by block."""
    one = lambda d, x: F.struct(
        (d["at"] + x).alias("at"), F.concat(d["sums"], F.array(d["at"])).alias("sums")
    )
    ints = F.array().cast("array<int>")
    blocks = F.transform(
        F.sequence(F.lit(1), F.size(sizes), F.lit(BLOCK)),
        lambda b: F.aggregate(
            F.slice(sizes, b, BLOCK), F.struct(F.lit(0).alias("at"), ints.alias("sums")), one
        ),
    )
    moved = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("sums")),
        lambda d, b: F.struct(
            (d["at"] + b["at"]).alias("at"),
            F.concat(d["sums"], F.array(F.transform(b["sums"], lambda s: s + d["at"]))).alias("sums"),
        ),
    )
    return F.flatten(moved["sums"])


def spans(text: Column, kind: str, pattern: str, value: int = 0, least: int = 1) -> Column:
    """Leftmost matches that do not overlap, as spans in code points.

    ``value`` is the group that holds the secret; matches whose value has fewer than ``least``
    characters are dropped. A text cut at its matches has the parts between them, and lengths
    of those and of the matches add up to places.
    """
    group = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(group(0))), lambda x: F.length(x))
    sizes = F.transform(group(0), lambda x: F.length(x))
    parts = F.arrays_zip(
        gaps.alias("gap"),
        sizes.alias("size"),
        sums_before(F.zip_with(gaps, sizes, lambda g, s: g + s)).alias("before"),
        group(value).alias("value"),
    )
    found = F.transform(
        F.filter(parts, lambda x: F.length(x["value"]) >= least),
        lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            (x["before"] + x["gap"]).alias("start"),
            (x["before"] + x["gap"] + x["size"]).alias("end"),
            x["value"].alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array()).cast(SPANS)


def looks_random(value: Column) -> Column:
    """Long, with digits and letters, and of many different characters."""
    return (
        (F.length(value) >= BARE)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= VARIED)
    )


def listed(found: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    fields = ("start", "kind", "end")
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(*(x[f].alias(f) for f in fields))))
    return F.array_join(
        F.transform(
            ordered,
            lambda x: F.concat_ws(
                ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def ownership(held: DataFrame, wide: int = WIDE) -> DataFrame:
    """Who holds a value: (digest, owners, repositories, places, verdict).

    ``held`` has rows (digest, owner, repository, announced, random). Places are counted for
    each repository first, then for each owner, so a value that is a third of all rows sends
    a row a task at most. Values that nothing ever announces are left out. ``copied``: held
    by ``wide`` owners or more, as examples and published keys are. ``live``: one owner alone,
    and random to look at. ``unsure``: all others.
    """
    repositories = held.groupBy("digest", "owner", "repository").agg(
        F.count("*").alias("places"), F.max("announced").alias("announced"), F.max("random").alias("random")
    )
    owners = repositories.groupBy("digest", "owner").agg(
        F.count("*").alias("repositories"),
        F.sum("places").alias("places"),
        F.max("announced").alias("announced"),
        F.max("random").alias("random"),
    )
    values = owners.groupBy("digest").agg(
        F.count("*").alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.sum("places").alias("places"),
        F.max("announced").alias("announced"),
        F.max("random").alias("random"),
    )
    verdict = (
        F.when(F.col("owners") >= wide, "copied")
        .when((F.col("owners") == 1) & F.col("random"), "live")
        .otherwise("unsure")
    )
    return values.filter("announced").select(
        "digest", "owners", "repositories", "places", verdict.alias("verdict")
    )


def scan_secrets(
    docs: DataFrame,
    wide: int = WIDE,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "lang",
) -> DataFrame:
    """Secrets of each document: doc_id, base, spans, one row per input row.

    ``base``: structs (kind, start, end, value) of what the patterns find: values assigned to
    telling names, access key ids, long hex numbers; values are SHA-256 digests. ``spans`` has
    those and, of kind ``bare``, runs that nothing announces but that are announced elsewhere
    as a live-looking value; each with owners, repositories and verdict (see ``ownership``).
    Places are in code points, ends exclusive.

    Candidates of whole texts are hashed and counted over all rows by the owners and
    repositories (an owner's ``repository_col``) that hold them. Null owners or repositories
    count as one of that kind. Null text has no secrets; null and repeated ids, equal or
    not, are rows of their own. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(
        spans(text, "assign", ASSIGN, 2, ASSIGN_LEAST), spans(text, "access", ACCESS), spans(text, "hex", HEX)
    )
    # A run that holds a key or a hex number is no find of its own.
    bare = F.filter(
        spans(text, "bare", RUN),
        lambda x: looks_random(x["value"]) & ~x["value"].rlike(f"{ACCESS}|{HEX}"),
    )
    hashed = lambda found: F.transform(
        found,
        lambda x: F.struct(
            x["kind"].alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.sha2(x["value"], 256).alias("value"),
            looks_random(x["value"]).alias("random"),
        ),
    )
    found = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(repository_col).cast("string"), F.lit("")).alias("repository"),
            hashed(base).alias("base"),
            hashed(bare).alias("bare"),
        ).withColumn("row_id", F.monotonically_increasing_id())
    )
    places = found.select(
        "row_id", "owner", "repository", F.explode(F.concat("base", "bare")).alias("x")
    ).select("row_id", "owner", "repository", "x.*")
    # An assigned value goes on to the end of its run.
    assigned = places.filter(F.col("kind") == 0).select("row_id", "end")
    alone = places.filter(F.col("kind") == 3).join(assigned, ["row_id", "end"], "left_anti")
    places = places.filter(F.col("kind") < 3).unionByName(alone.select(*places.columns))
    values = ownership(
        places.select(
            F.col("value").alias("digest"), "owner", "repository", (F.col("kind") < 3).alias("announced"), "random"
        ),
        wide,
    )
    judged = (
        places.join(values, places["value"] == values["digest"])
        .filter((F.col("kind") < 3) | (F.col("verdict") == "live"))
        .groupBy("row_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("start", "kind", "end", "value", "owners", "repositories", "verdict")
                )
            ).alias("spans")
        )
    )
    kept = F.transform("base", lambda x: x.dropFields("random"))
    none = F.array().cast(judged.schema["spans"].dataType)
    return found.join(judged, "row_id", "left").select(
        "doc_id", kept.alias("base"), F.coalesce("spans", none).alias("spans")
    )
