"""Allele calls as expressions over four count columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")
SNP_TYPES = ("mono", "bi", "tri", "quad")


def call_alleles(counts: dict[str, Column], depth: Column, maf: float, least: int = 2) -> Column:
    """Struct of n, major, minor, snp_type; all but n are null where no allele passes.

    An allele passes with at least `least` observations that make up at least maf of the depth.
    Alleles are ordered by count, then letter; minor is the second, or the first if it is alone.
    """
    one = lambda b: F.when((counts[b] >= least) & (F.try_divide(counts[b], depth) >= maf), F.struct((-counts[b]).alias("order"), F.lit(b).alias("base")))
    passing = F.array_sort(F.array_compact(F.array(*[one(b) for b in BASES])))
    n = F.size(passing)
    base = lambda i: F.get(passing, i)["base"]
    return F.struct(
        n.alias("n"),
        base(F.lit(0)).alias("major"),
        base(F.least(n, F.lit(2)) - 1).alias("minor"),
        F.get(F.array(*[F.lit(t) for t in SNP_TYPES]), n - 1).alias("snp_type"),
    )


def count_of(base: Column, counts: dict[str, Column]) -> Column:
    """The count of the base named by a column."""
    return F.coalesce(*[F.when(base == b, counts[b]) for b in BASES])


def unambiguous(counts: dict[str, Column]) -> Column:
    """No two counts above zero are equal."""
    seen = F.filter(F.array(*[counts[b] for b in BASES]), lambda x: x > 0)
    return F.size(seen) == F.size(F.array_distinct(seen))


def packed_counts(counts: dict[str, Column]) -> Column:
    """The four counts as text, A, C, G, T with commas between."""
    return F.concat_ws(",", *[counts[b].cast("string") for b in BASES])


def unpacked_counts(text: Column) -> dict[str, Column]:
    parts = F.split(text, ",")
    return {b: parts[i].cast("long") for i, b in enumerate(BASES)}


def site_id(*parts: Column) -> Column:
    return F.concat_ws("|", *parts)


def parse_site_id(site: Column) -> Column:
    """Struct of ref_id, ref_pos, ref_allele; cut from the right, as contig ids may hold the separator."""
    pattern = r"^(.*)\|([^|]*)\|([^|]*)$"
    return F.struct(F.regexp_extract(site, pattern, 1).alias("ref_id"), F.regexp_extract(site, pattern, 2).cast("long").alias("ref_pos"), F.regexp_extract(site, pattern, 3).alias("ref_allele"))
