"""Exact dedup as a tree merge of digest runs, in DataFrame operations only.

Every row gets a run number. In each round the runs whose numbers agree above the next
``FAN_BITS`` bits exchange their digests and are merged, and every digest keeps one winner, so
after the last round one winner is left for each digest in the whole table. A group of equal
texts, however large, is thus cut down inside its runs, run by run, and no task ever sees more
than one merge step's share of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightmill.llm.common import ascii_lower, scratch_names

FAN_BITS = 4


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text; NULL counts as empty."""
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def _merge(runs: DataFrame, level: Column, smallest: bool) -> DataFrame:
    """One round: runs of the same ``level`` become one, sorted and merged by digest.

    The byte length travels with the digest and is part of the key, which verifies that equal
    digests stand for texts of equal length.
    """
    best = F.min if smallest else F.max
    return runs.groupBy(level.alias("run"), "digest", "size").agg(
        best("winner").alias("winner"), F.sum("members").alias("members")
    )


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    keep: str = "largest",
    rounds: int = 3,
) -> DataFrame:
    """One row for each distinct text: digest, size (bytes), winner (an id), members (rows).

    ``rounds`` binomial rounds over 2 ** (4 * (rounds - 1)) runs; the default of 3 rounds
    merges 256 runs, then 16, then 1. ``keep``: "largest" or "smallest" id wins. NULL ids
    win only where a group has no other id. An empty table gives no rows.
    """
    run_bits = FAN_BITS * (rounds - 1)
    runs = docs.select(
        F.pmod(F.xxhash64(F.col(f"`{id_column}`")), F.lit(1 << run_bits)).alias("run"),
        digest(F.col(f"`{text}`")).alias("digest"),
        F.octet_length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("size"),
        F.col(f"`{id_column}`").alias("winner"),
        F.lit(1).cast("long").alias("members"),
    )
    for step in range(rounds):
        level = F.shiftright("run", FAN_BITS if step else 0)
        runs = _merge(runs, level, keep == "smallest")
    return runs.select("digest", "size", "winner", "members")


def mark_exact_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    keep: str = "largest",
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (``columns``, default all) with keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; NULL equals the empty text.
    Rows that repeat the winner's id in the same group are all marked as kept, as nothing
    tells them apart. Columns named like a result are replaced.
    """
    results = ["keep_id", "group_size", "kept", "text_sha256"]
    kept = [c for c in (columns or docs.columns) if c not in results]
    key, size, row_id, group_key, group_octets, members = scratch_names(
        docs, "digest", "size", "id", "group_digest", "group_octets", "members"
    )
    source = docs.select(
        *[f"`{c}`" for c in kept],
        digest(F.col(f"`{text}`")).alias(key),
        F.octet_length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias(size),
        F.col(f"`{id_column}`").alias(row_id),
    )
    groups = exact_groups(docs, text, id_column, keep)
    joined = source.join(
        groups.withColumnsRenamed(
            {"digest": group_key, "size": group_octets, "winner": "keep_id", "members": members}
        ),
        (F.col(key) == F.col(group_key)) & (F.col(size) == F.col(group_octets)),
    )
    return joined.select(
        *[f"`{c}`" for c in kept],
        "keep_id",
        F.col(members).alias("group_size"),
        F.col(row_id).eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col(key).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: str = "largest"
) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; one row even where rows repeat."""
    names = scratch_names(docs, "keep", "members", "kept", "sha")
    plain = dict(zip(["keep_id", "group_size", "kept", "text_sha256"], names))
    source = docs.withColumnsRenamed(plain)  # a clash with a result column is renamed away
    back = {v: k for k, v in plain.items()}
    text, id_column = plain.get(text, text), plain.get(id_column, id_column)
    stay = mark_exact_duplicates(source, text, id_column, keep).where("kept")
    first = stay.dropDuplicates(["text_sha256", "keep_id"])
    return first.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in source.columns])
