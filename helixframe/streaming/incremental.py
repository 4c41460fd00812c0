"""Pooled site counts over a growing set of samples, as an extension: sums per site are algebraic, so samples may arrive one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import BASES
from ..operators.pileup import COUNTS


def pooled_stream(sites: DataFrame) -> DataFrame:
    """Running rc_ and sc_ counts of each site; write it in update mode. State is one row a site."""
    reads = [F.sum(c).alias(f"rc_{b.lower()}") for b, c in zip(BASES, COUNTS, strict=True)]
    samples = [F.sum((F.col(c) > 0).cast("int")).alias(f"sc_{b.lower()}") for b, c in zip(BASES, COUNTS, strict=True)]
    return sites.groupBy("species_id", "ref_id", "ref_pos", "ref_allele").agg(F.count(F.lit(1)).alias("count_samples"), *reads, *samples)
