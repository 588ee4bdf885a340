"""Exact deduplication by content-defined chunk recipes (built-in functions only).

1. Each text (A-Z lower-cased) is cut where its content says so: after a
   sentence end or line feed, at least ``MIN_CHUNK`` and at most
   ``MAX_CHUNK`` characters from the last cut.  Equal texts have equal cuts.
2. A chunk is named by a 64-bit hash and proved by its SHA-256.  One
   aggregation over all chunks finds hashes that stand for more than one
   chunk; documents that hold such a hash use the proofs as identifiers
   instead, so an identifier names one chunk text only.
3. Documents are equal when their ordered identifier lists are equal.  Only
   lists and digests are shuffled, never texts.

A group of copies of any size is aggregated map-side first; no window runs
over a group, and rows meet their group by a join that adaptive execution
can split where one list is hot.

Cases: a null text equals the empty text (both have the empty list); of
equal texts the largest key stays, a null key counts as smallest; among
repeated rows of that key and text exactly one stays, first by
``tie_break`` (a hash of the further columns), then any as they are equal;
an empty table gives no rows.  ``distinct_documents`` returns all columns of
the kept rows, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import row_hash, stored

MIN_CHUNK, MAX_CHUNK = 512, 4096


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def chunks(text: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """The chunks of a text, in order; concatenated they are the text."""
    pattern = rf"(?s).{{{low},{high - 1}}}?[.!?\n]|.{{1,{high}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_recipes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tie_break: Column | None = None,
    chunk_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per distinct (key, text, tie-break) with its number of rows,
    text digest, chunk hashes and chunk proofs.  Texts stay behind."""
    norm = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    cut = (
        docs.select(
            F.col(key).alias("key"),
            norm.alias("norm"),
            (F.lit(0).cast("long") if tie_break is None else tie_break).alias("tie"),
        )
        .withColumn("chunks", chunks(F.col("norm")))
        .select(
            "key",
            "tie",
            F.sha2("norm", 256).alias("digest"),
            F.transform("chunks", lambda c: chunk_hash(c).cast("long")).alias("ids"),
            F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("proofs"),
        )
    )
    return cut.groupBy("key", "tie", "digest", "ids", "proofs").agg(F.count("*").alias("copies"))


def verified(recipes: DataFrame) -> DataFrame:
    """Recipes with ``parts``, the identifier list to compare: the hashes, or
    also the proofs where a hash of the list stands for several chunks."""
    named = recipes.select("ids", F.explode(F.arrays_zip("ids", "proofs")).alias("chunk")).select(
        "ids", F.col("chunk.ids").alias("id"), F.col("chunk.proofs").alias("proof")
    )
    shared = (
        named.groupBy("id")
        .agg(F.min("proof").alias("low"), F.max("proof").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("id")
    )
    if shared.isEmpty():
        return recipes.withColumn("parts", F.struct("ids", F.lit(None).cast("array<binary>").alias("proofs")))
    doubtful = named.join(shared, "id", "left_semi").select("ids").distinct()
    marked = recipes.join(doubtful.withColumn("doubtful", F.lit(True)), "ids", "left")
    return marked.withColumn(
        "parts", F.struct("ids", F.when(F.col("doubtful"), F.col("proofs")).alias("proofs"))
    ).drop("doubtful")


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tie_break: Column | None = None,
    chunk_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Distinct (key, text, tie) rows with copies, keep_id, group_size, kept."""
    recipes = verified(stored(chunk_recipes(docs, key, text, tie_break, chunk_hash), "recipes"))
    # written, so that the join below deals both sides itself and can split a hot list
    groups = stored(
        recipes.groupBy("parts")
        .agg(
            F.max(F.struct("key", "tie")).alias("keep"),
            F.sum("copies").alias("group_size"),
            F.count("*").alias("members"),
        )
        .where("members > 1")
        .drop("members"),
        "groups",
    )
    own = F.struct("key", "tie")
    return (
        recipes.join(groups, "parts", "left")
        .select(
            "key",
            "tie",
            "digest",
            "copies",
            F.coalesce("keep", own).alias("keep"),
            F.coalesce("group_size", "copies").alias("group_size"),
        )
        .select(
            "key",
            "tie",
            "digest",
            "copies",
            F.col("keep.key").alias("keep_id"),
            "group_size",
            (
                F.col("keep.key").eqNullSafe(F.col("key"))
                & F.col("keep.tie").eqNullSafe(F.col("tie"))
            ).alias("kept"),
        )
    )


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: key, keep_id, group_size, kept, text_sha256."""
    groups = exact_groups(docs, key, text)
    return groups.select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"),
    ).select(key, "keep_id", "group_size", (F.col("kept") & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    others = [c for c in docs.columns if c not in (key, text)]
    tie = row_hash([F.col(f"`{c}`") for c in [*others, text]])
    kept = (
        exact_groups(docs, key, text, tie)
        .where("kept")
        .select("key", "tie", "digest", F.col("copies"))
    )
    norm = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        tie.alias("tie"),
        F.sha2(norm, 256).alias("digest"),
    )
    same = (
        rows["tie"].eqNullSafe(kept["tie"])
        & (rows["digest"] == kept["digest"])
        & rows[f"row.{key}"].eqNullSafe(kept["key"])
    )
    found = rows.join(kept, same).select("row", rows["tie"], rows["digest"], "copies")
    single = found.where("copies = 1").select("row.*")
    repeated = found.where("copies > 1").withColumn("key", F.col(f"row.`{key}`"))
    return single.unionByName(repeated.dropDuplicates(["key", "tie", "digest"]).select("row.*"))
