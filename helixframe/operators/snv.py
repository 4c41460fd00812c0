"""Variants of a population: samples pooled site by site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import BASES, SNP_TYPES, call_alleles, count_of
from .pileup import COUNTS, counts


def relevant(summaries: DataFrame, *, genome_depth: float = 5.0, genome_coverage: float | None = 0.4, sample_counts: int = 2) -> DataFrame:
    """Samples of each species that are deep and covered enough, of species that enough samples have; adds samples_count."""
    keep = F.col("mean_depth") >= genome_depth
    if genome_coverage is not None:
        keep &= F.col("fraction_covered") >= genome_coverage
    found = summaries.filter(keep)
    # Summaries have a row per sample and species: a grouped count joins back small to small.
    n = found.groupBy("species_id").agg(F.count(F.lit(1)).alias("samples_count")).filter(F.col("samples_count") >= sample_counts)
    return found.join(n, "species_id")


def noise_floor(sites: DataFrame, *, floor: int = 2) -> DataFrame:
    """Counts up to the floor become 0; depth follows."""
    cleaned = [F.when(F.col(c) > floor, F.col(c)).otherwise(0).alias(c) for c in COUNTS]
    return sites.select(*[c for c in sites.columns if c not in (*COUNTS, "depth")], *cleaned).withColumn("depth", sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0])))


def site_filter(sites: DataFrame, samples: DataFrame, *, site_depth: int = 5, site_ratio: float = 3.0) -> DataFrame:
    """Sites of relevant samples that are deep, but not too deep for their sample. samples: sample_name, species_id, mean_depth."""
    joined = sites.join(samples.select("sample_name", "species_id", "mean_depth", "samples_count"), ["sample_name", "species_id"])
    return joined.filter((F.col("depth") >= site_depth) & (F.col("depth") / F.col("mean_depth") <= site_ratio))


def pooled(sites: DataFrame, *, keep_samples: bool = False) -> DataFrame:
    """Reads (rc_) and samples (sc_) of each base at every site of a species, over all samples that passed; with keep_samples also what each of them has (samples: sample_name and counts)."""
    reads = [F.sum(c).alias(f"rc_{b.lower()}") for b, c in zip(BASES, COUNTS, strict=True)]
    samples = [F.count_if(F.col(c) > 0).alias(f"sc_{b.lower()}") for b, c in zip(BASES, COUNTS, strict=True)]
    each = [F.collect_list(F.struct("sample_name", *COUNTS)).alias("samples")] if keep_samples else []
    return sites.groupBy("species_id", "ref_id", "ref_pos", "ref_allele").agg(F.count(F.lit(1)).alias("count_samples"), F.first("samples_count").alias("samples_count"), *reads, *samples, *each)


def prevalent(sites: DataFrame, *, snv_type: str = "common", site_prev: float = 0.9) -> DataFrame:
    prevalence = F.col("count_samples") / F.col("samples_count")
    if snv_type not in ("common", "rare"):
        raise ValueError(f"snv_type is common or rare, not {snv_type}")
    return sites.filter(prevalence >= site_prev if snv_type == "common" else prevalence <= site_prev)


def population(sites: DataFrame, *, method: str = "prevalence", snp_maf: float = 0.05, snp_types: Sequence[str] = ("bi", "tri", "quad")) -> DataFrame:
    """Major and minor allele and snp_type of pooled sites; snp_types may be ("any",)."""
    prefix, depth = ("rc_", sum((F.col(f"rc_{b.lower()}") for b in BASES[1:]), F.col("rc_a"))) if method == "abundance" else ("sc_", F.col("count_samples"))
    called = sites.withColumn("call", call_alleles(counts(prefix), depth, snp_maf)).filter("call.n > 0")
    found = called.withColumn("major_allele", F.col("call.major")).withColumn("minor_allele", F.col("call.minor")).withColumn("snp_type", F.col("call.snp_type")).drop("call")
    wanted = [t for t in SNP_TYPES if t in snp_types]
    return found if "any" in snp_types else found.filter(F.col("snp_type").isin(wanted))


def of_locus(annotated: DataFrame, *, locus_types: Sequence[str] = ("any",)) -> DataFrame:
    """Sites of the locus types wanted (CDS, IGR, tRNA, ...); "any" keeps all."""
    return annotated if "any" in locus_types else annotated.filter(F.col("locus_type").isin(list(locus_types)))


def depth_and_frequency(struct: Column | None = None) -> tuple[Column, Column]:
    """Depth of major and minor allele and the minor one's frequency, -1 without depth, from counts (columns, or the fields of a struct)."""
    of = {b: F.coalesce(F.col(c) if struct is None else struct[c], F.lit(0)) for b, c in zip(BASES, COUNTS, strict=True)}
    major, minor = (count_of(F.col(c), of) for c in ("major_allele", "minor_allele"))
    alone = F.col("major_allele") == F.col("minor_allele")
    depth = F.when(alone, major).otherwise(major + minor)
    return depth, F.when(depth == 0, -1.0).when(alone, 0.0).otherwise(minor / depth)


def frequencies(called: DataFrame, samples: DataFrame) -> DataFrame:
    """Depth and minor frequency of every called site (with its samples, see pooled) in every relevant sample.

    A sample without the site, or with neither allele, has depth 0 and frequency -1. No site is looked
    up: the samples that lack are those of the species that the site's list has not.
    """
    key = ["species_id", "ref_id", "ref_pos", "ref_allele"]
    # One row a species with all its samples.
    names = samples.groupBy("species_id").agg(F.collect_set("sample_name").alias("sample_names"))
    absent = F.transform(F.array_except("sample_names", F.col("samples")["sample_name"]), lambda n: F.struct(n.alias("sample_name"), *[F.lit(0).cast("long").alias(c) for c in COUNTS]))
    present = F.transform("samples", lambda s: F.struct(s["sample_name"].alias("sample_name"), *[s[c].cast("long").alias(c) for c in COUNTS]))
    each = called.join(names, "species_id").withColumn("in", F.explode(F.concat(present, absent)))
    depth, maf = depth_and_frequency(F.col("in"))
    return each.select("in.sample_name", *key, depth.alias("sample_depth"), maf.alias("sample_maf"))


def sample_frequencies(called: DataFrame, sites: DataFrame, samples: DataFrame) -> DataFrame:
    """The same from a table of sites that called knows nothing of: each sample's site is looked up."""
    key = ["species_id", "ref_id", "ref_pos", "ref_allele"]
    names = samples.groupBy("species_id").agg(F.collect_set("sample_name").alias("sample_names"))
    every = called.select(*key, "major_allele", "minor_allele").join(names, "species_id").withColumn("sample_name", F.explode("sample_names")).drop("sample_names")
    have = every.join(sites.select("sample_name", *key, *COUNTS), ["sample_name", *key], "left")
    depth, maf = depth_and_frequency()
    return have.select("sample_name", *key, depth.alias("sample_depth"), maf.alias("sample_maf"))


def sample_arrays(long: DataFrame, key: Sequence[str], value: str, numbers: DataFrame, missing: float | int) -> DataFrame:
    """key and values: of each row one array, in the order of the samples' numbers (numbers: sample_name, number from 0), missing where it has none.

    Only what is there is shuffled and held; the array is filled up as the row is written. Any number of samples is one column and one aggregate.
    """
    n = numbers.agg((F.max("number") + 1).alias("_n"))  # a row
    one = F.when(F.col("number").isNotNull(), F.struct(F.col("number").cast("int").alias("number"), F.col(value).alias("value")))
    placed = long.join(numbers.select("sample_name", "number"), "sample_name", "left").groupBy(*key).agg(F.collect_list(one).alias("_have"))
    every = F.sequence(F.lit(0), F.col("_n").cast("int") - 1)
    kind = dict(long.dtypes)[value]
    absent = F.transform(F.array_except(every, F.col("_have")["number"]), lambda k: F.struct(k.alias("number"), F.lit(missing).cast(kind).alias("value")))
    filled = F.transform(F.array_sort(F.concat("_have", absent)), lambda x: F.coalesce(x["value"], F.lit(missing).cast(kind)))
    return placed.crossJoin(F.broadcast(n)).select(*key, filled.alias("values"))


def matrix(long: DataFrame, key: Sequence[str], sample: str, value: str, names: Sequence[str], missing: float | int) -> DataFrame:
    """One column per sample, in the order of names; for a few samples. Any number of them is an array, see sample_arrays."""
    numbers = long.sparkSession.createDataFrame([(n, k) for k, n in enumerate(names)], "sample_name string, number int")
    rows = sample_arrays(long.withColumn("sample_name", F.col(sample)), key, value, numbers, missing)
    return rows.select(*key, *[F.get("values", F.lit(k)).alias(n) for k, n in enumerate(names)])
