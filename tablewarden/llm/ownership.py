"""Secrets in texts, told from copied examples by how many owners hold the same value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablewarden.llm.common import cut_lineage, spread_join

# The names of the base patterns and what follows them.
NAMES = "password|passwd|secret|token|api_?key"
ASSIGNED = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_ASSIGNED = 12


def either_case(pattern: str) -> str:
    """The pattern with every ASCII letter in both cases, so that no regular-expression engine adds other letters."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in pattern)


@dataclass(frozen=True)
class Kind:
    """A pattern whose matches are found leftmost and without overlap. ``value`` is the group that holds the secret."""

    name: str
    pattern: str
    value: int = 0


# A base match stays whatever its frequency. Where every run that is long enough is found by a pattern with the least length in
# it, that is the pattern; an assignment that is too short still takes its place, so its length is looked at afterwards.
BASE = [
    Kind("assign", f"({either_case(NAMES)}){ASSIGNED}", 2),
    Kind("access", "AKIA[A-Z0-9]{14,}"),
    Kind("hex", "[0-9a-f]{16,}"),
]
# Kinds that are reported only for one owner's live-looking values.
MORE = [
    Kind("named", f"({either_case('pwd|passphrase|credential|private_key|bearer')}){ASSIGNED}", 2),
    Kind("github", "gh[pousr]_[A-Za-z0-9]{20,}"),
    Kind("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("service", "sk[-_](?:live[-_]|test[-_]|proj[-_])?[A-Za-z0-9]{16,}"),
    Kind("google", "AIza[A-Za-z0-9_-]{30,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Kind("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----([A-Za-z0-9+/=\x20\x09\x0A\x0D]{40,})", 1),
    Kind("userinfo", r"://([^\x20\x09-\x0D/:@]{1,100}:[^\x20\x09-\x0D/@]{4,100})@", 1),
]
KINDS = [*BASE, *MORE]
# An assignment shorter than the base asks for.
SHORT = "short"
ORDER = [k.name for k in BASE] + [SHORT] + [k.name for k in MORE]
# A value of at least so many owners is a copied example.
COPIED_OWNERS = 3
# A live-looking value has at least so many characters, so many different ones, and none of these words.
LEAST_LIVE, LEAST_DIFFERENT = 8, 6
EXAMPLE_WORDS = "example|sample|dummy|changeme|placeholder|your|xxxx|test|1234567|abcdef"


def live_looking(value: Column) -> Column:
    """Long and varied enough for a credential, of letters and digits, and not spelled like an example."""
    different = F.size(F.array_distinct(F.split(value, "")))
    mixed = value.rlike("[A-Za-z]") & value.rlike("[0-9]")
    return (F.length(value) >= LEAST_LIVE) & (different >= LEAST_DIFFERENT) & mixed & ~value.rlike(either_case(EXAMPLE_WORDS))


def _matches(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """(_row, _id, _owner, _repo, _found): per kind with matches the lengths of the texts between them and the matches themselves.

    One pass tells the texts that hold any candidate; only those are cut by every pattern. Row numbers are stored with the
    rows, never made again.
    """
    given = docs.select(
        F.col(key).alias("_id"), F.col(owner).cast("string").alias("_owner"), F.col(repository).cast("string").alias("_repo"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    )
    flagged = given.withColumn("_any", F.col("_text").rlike("|".join(k.pattern for k in KINDS)))

    def cut(k: Kind) -> Column:
        gaps = F.transform(F.split("_text", k.pattern, -1), F.length)
        return F.struct(F.lit(k.name).alias("kind"), gaps.alias("gaps"), F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0)).alias("hits"))

    found = F.when(F.col("_any"), F.filter(F.array(*[cut(k) for k in KINDS]), lambda x: F.size(x["hits"]) > 0))
    return cut_lineage(flagged.select(F.monotonically_increasing_id().alias("_row"), "_id", "_owner", "_repo", found.alias("_found")))


def _spans(matched: DataFrame) -> DataFrame:
    """A row per match: its place in code points, its kind by the length of its value, the value's hash and whether it looks live."""
    zipped = F.arrays_zip(F.expr("slice(_f.gaps, 1, size(_f.hits))").alias("gap"), F.col("_f.hits").alias("hit"))
    of_kind = matched.select("_row", "_id", "_owner", "_repo", F.explode("_found").alias("_f")).select("_row", "_id", "_owner", "_repo", F.col("_f.kind").alias("_kind"), zipped.alias("_zipped"))
    # The lists are columns of their own here, so that a match is not carried on with all the others.
    each = of_kind.select("_row", "_id", "_owner", "_repo", "_kind", F.posexplode("_zipped").alias("_at", "_m"))
    value = None
    for k in KINDS:
        if k.value:
            part = F.regexp_extract("_m.hit", k.pattern, k.value)
            value = F.when(F.col("_kind") == k.name, part) if value is None else value.when(F.col("_kind") == k.name, part)
    each = each.withColumn("_value", value.otherwise(F.col("_m.hit"))).select(
        "_row", "_id", "_owner", "_repo", "_kind", "_at", F.col("_m.gap").alias("_gap"), F.length("_m.hit").alias("_length"),
        F.length("_value").alias("_size"), F.sha2("_value", 256).alias("_hash"), live_looking(F.col("_value")).alias("_live"),
    )
    # The matches of one text and kind: bounded by the text.
    before = W.partitionBy("_row", "_kind").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("_gap") + F.col("_length")).over(before)
    short = (F.col("_kind") == "assign") & (F.col("_size") < LEAST_ASSIGNED)
    return each.withColumn("_end", end).select(
        "_row", "_id", "_owner", "_repo", "_hash", "_live", F.when(short, SHORT).otherwise(F.col("_kind")).alias("_kind"), (F.col("_end") - F.col("_length")).alias("_start"), "_end"
    )


def frequencies(spans: DataFrame) -> DataFrame:
    """(_hash, n_owners, n_repositories) over the whole corpus: distinct owners, and distinct repositories of owners.

    Three partial aggregates, so a value that stands in a third of all texts sends a row per task and repository at most,
    spread by repository.
    """
    places = spans.groupBy("_hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("_n"))
    owners = places.groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("_repos"))
    return owners.groupBy("_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("_repos").alias("n_repositories"))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """``key``, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied for every row.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. Base kinds are always listed; the others
    only where the value looks live and fewer than ``copied_owners`` owners hold it. n_live counts all spans of such values,
    n_copied those of values with more owners. Owners and repositories are columns of the table; a repository belongs to its
    owner, and a null is a name like any other.

    Null and empty texts have no spans; null and repeated keys are rows like any other, repeated rows do not add to a value's
    owners; other columns are ignored; an empty table gives an empty result.
    """
    matched = _matches(docs, key, text, owner, repository)
    spans = cut_lineage(_spans(matched.filter(F.size("_found") > 0)))
    judged = spread_join(spans, frequencies(spans), ["_hash"], ["_row"], "inner")
    own = F.col("_live") & (F.col("n_owners") < copied_owners)
    order = F.array_position(F.array(*[F.lit(n) for n in ORDER]), F.col("_kind")).alias("order")
    base = F.col("_kind").isin([k.name for k in BASE])
    told = F.concat_ws(":", "_kind", F.col("_start").cast("string"), F.col("_end").cast("string")).alias("told")
    of_text = judged.groupBy("_row").agg(
        F.first("_id").alias("_id"),
        *[F.count_if(F.col("_kind") == k.name).alias(f"n_{k.name}") for k in BASE],
        F.sort_array(F.collect_list(F.when(base | own, F.struct(F.col("_start").alias("start"), order, base.alias("base"), told)))).alias("_spans"),
        F.count_if(own).alias("n_live"),
        F.count_if(F.col("n_owners") >= copied_owners).alias("n_copied"),
    )
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: s["told"]), ",")
    listed = of_text.select(
        F.col("_id").alias(key), "n_assign", "n_access", "n_hex", F.sha2(joined(F.filter("_spans", lambda s: s["base"])), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"), "n_live", "n_copied",
    )
    zero = F.lit(0).cast("bigint")
    clean = matched.filter("_found IS NULL OR size(_found) = 0").select(
        F.col("_id").alias(key), zero.alias("n_assign"), zero.alias("n_access"), zero.alias("n_hex"), F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"), zero.alias("n_live"), zero.alias("n_copied"),
    )
    return clean.unionByName(listed)
