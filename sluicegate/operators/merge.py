"""Bringing pulled rows into a target, and comparing a target with its source."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, functions as F

from ..functions.types import quote
from .cdc import IS_DELETED


def _by_key(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``__old`` and ``__new`` row of every key of either side, NULL where there is none.

    Each side is read and moved once. A new row without a whole key fails the merge, as it would be added again each
    time; such rows of ``base`` stay.
    """
    sides = []
    for rows, row in ((base, "__old"), (new, "__new")):
        named = [F.col(quote(k)).alias(f"{row}{i}") for i, k in enumerate(keys)]
        whole = F.struct(*(F.col(quote(c)) for c in rows.columns))
        if row == "__new":
            keyless = reduce(or_, (F.col(quote(k)).isNull() for k in keys))
            whole = F.when(keyless, F.raise_error(F.lit(f"A row to be merged has a NULL in its key {keys}."))).otherwise(whole)
        sides.append(rows.select(*named, whole.alias(row)))
    same = reduce(and_, (F.col(f"__old{i}") == F.col(f"__new{i}") for i in range(len(keys))))
    return sides[0].join(sides[1], same, "full_outer")


def _present(met: DataFrame, columns: list[str]) -> DataFrame:
    has_new = F.col("__new").isNotNull()
    old, new = F.col("__old"), F.col("__new")
    return met.select(*(F.when(has_new, new.getField(c)).otherwise(old.getField(c)).alias(c) for c in columns))


def upsert(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the rows of ``new`` put in by key; each side holds a key once."""
    return _present(_by_key(base, new, keys), base.columns)


def apply_changes(base: DataFrame, net: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` after net changes: deleted keys are gone, all others have their new row. Keys as in ``upsert``."""
    met = _by_key(base, net, keys)
    gone = F.coalesce(F.col("__new").getField(IS_DELETED) == 1, F.lit(False))
    return _present(met.where(~gone), base.columns)


def merge_into(table: str, net: DataFrame, keys: list[str]) -> None:
    """The same as a MERGE, for table formats that have one; only touched files are written anew."""
    columns = [c for c in net.columns if c != IS_DELETED]
    values = {c: F.col(f"net.{quote(c)}") for c in columns}
    same = reduce(and_, (F.col(f"{table}.{quote(k)}") == F.col(f"net.{quote(k)}") for k in keys))
    merge = net.alias("net").mergeInto(table, same)
    if IS_DELETED in net.columns:
        gone = F.col(f"net.{IS_DELETED}") == 1
        merge = merge.whenMatched(gone).delete().whenMatched().update(values).whenNotMatched(~gone).insert(values)
    else:
        merge = merge.whenMatched().update(values).whenNotMatched().insert(values)
    merge.merge()


def reconcile(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Rows that source and copy do not hold equally often, with both counts.

    Both sides are counted together by whole row, NULLs equal, so one shuffle finds what is missing
    and what is extra, and copies of one row are counted before they move.
    """
    columns = [F.col(quote(c)) for c in source.columns]
    both = source.select(*columns, F.lit(1).alias("__s"), F.lit(0).alias("__c")).unionByName(
        copy.select(*columns, F.lit(0).alias("__s"), F.lit(1).alias("__c"))
    )
    counted = both.groupBy(*columns).agg(F.sum("__s").alias("in_source"), F.sum("__c").alias("in_copy"))
    return counted.where(F.col("in_source") != F.col("in_copy"))


#: Most buckets that are named one by one in a filter; more are met by a join.
_LISTED = 1_000


def _key_bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*(F.col(quote(k)) for k in keys)), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Order-free digests of the rows in each bucket of keys: ``bucket``, ``rows`` and two sums of independent row hashes.

    A NULL counts by its place. Every task sums its own rows first, so at most ``buckets`` rows a task move.
    """
    values = [x for c in df.columns for x in (F.col(quote(c)), F.col(quote(c)).isNull())]
    hashes = F.xxhash64(*values), F.xxhash64(F.lit("second"), *reversed(values))
    sums = [F.sum(h.cast("decimal(20,0)")).alias(f"sum{i}") for i, h in enumerate(hashes)]
    return df.groupBy(_key_bucket(keys, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def differing_buckets(source: DataFrame, copy: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Buckets (``bucket``) of which source and copy hold other rows."""
    here, there = digests(source, keys, buckets), digests(copy.select(*(quote(c) for c in source.columns)), keys, buckets)
    named = there.select("bucket", *(F.col(c).alias(f"copy_{c}") for c in ("rows", "sum0", "sum1")))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"copy_{c}")) for c in ("rows", "sum0", "sum1")))
    return here.join(named, "bucket", "full_outer").where(~same).select("bucket")


def reconcile_by_digests(source: DataFrame, copy: DataFrame, keys: list[str], buckets: int = 65_536) -> DataFrame:
    """The rows of ``reconcile``, of which only those move whose buckets of keys differ.

    Both sides are read twice: for their digests, a row a bucket and task, and for the rows of differing buckets, so what is
    shuffled grows with the differences. Rows that differ in a key are found in two buckets. Bucket numbers are looked up
    before the second read; the driver holds ``buckets`` numbers at most.
    """
    found = sorted(r["bucket"] for r in differing_buckets(source, copy, keys, buckets).collect())
    spark, bucket = source.sparkSession, _key_bucket(keys, buckets)
    if len(found) <= _LISTED:
        return reconcile(source.where(bucket.isin(found)), copy.where(bucket.isin(found)))
    listed = spark.createDataFrame([(b,) for b in found], "__bucket int")
    opened = [side.join(listed, bucket == F.col("__bucket"), "left_semi") for side in (source, copy)]
    return reconcile(*opened)
