"""Directory listings and what changed between two of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.plans.ordered import arrange, run_count
from flowtables.plans.sizes import written


def list_directory(spark: SparkSession, path: str, recursive: bool = False, fingerprint: bool = False) -> DataFrame:
    """``path``, ``modified_at``, ``length`` of the files in a folder; their
    content is only read for a ``fingerprint``, its SHA-256."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    content = [F.sha2("content", 256).alias("fingerprint")] if fingerprint else []
    return reader.load(path).select(
        "path", F.col("modificationTime").alias("modified_at"), "length", *content
    )


def directory_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``path`` and ``change`` (Creation, Modification or Deletion) between two
    listings.  A file is modified if its time or length differs.  Listings without
    fingerprints do not tell a rename from a deletion and a creation, so it shows as
    those two; see :func:`directory_renames`."""
    old = before.select("path", F.struct("modified_at", "length").alias("_old"))
    new = after.select("path", F.struct("modified_at", "length").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "Creation")
        .when(F.col("_new").isNull(), "Deletion")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "Modification")
    )
    both = old.join(new, "path", "full_outer")
    return both.select("path", change.alias("change")).where(F.col("change").isNotNull())


def directory_renames(before: DataFrame, after: DataFrame, rows_per_chunk: int | None = None) -> DataFrame:
    """:func:`directory_changes` of listings with a ``fingerprint``, where a renamed file is one
    Modification of its new path; ``renamed_from`` is the path it had.

    A file that is gone and a new one of the same fingerprint and length are one file.  Of
    several such files, the first that is gone in the order of paths became the first new one,
    and so on; what is left over was deleted or created.  However many files are alike (all
    empty ones are), none of them share a task beyond a chunk.  A file without a fingerprint is like no other.
    """
    changes = directory_changes(before, after)
    kinds = []
    for listing, change, path in ((before, "Deletion", "renamed_from"), (after, "Creation", "path")):
        own = changes.where(F.col("change") == change).select(F.col("path").alias("_path"))
        files = listing.select("path", "length", "fingerprint").where("fingerprint IS NOT NULL")
        moved = files.join(own, F.col("path") == F.col("_path")).drop("_path")
        numbered = arrange(moved, ("fingerprint", "length"), "path", rows_per_chunk).scan(nth=run_count()).df
        kinds.append(numbered.withColumnRenamed("path", path))
    renamed = written(kinds[0].join(kinds[1], ["fingerprint", "length", "nth"]).select("path", "renamed_from"), "renamed")
    gone = renamed.select(F.col("renamed_from").alias("path"), F.lit("Deletion").alias("change"))
    plain = changes.join(gone, ["path", "change"], "left_anti").join(renamed, "path", "left")
    return plain.select("path", F.when(F.col("renamed_from").isNotNull(), "Modification").otherwise(F.col("change")).alias("change"), "renamed_from")
