"""Species abundance from hits of reads on marker genes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import kept


def passing_hits(hits: DataFrame, cutoffs: DataFrame | None = None, *, aln_mapid: float | None = None, aln_cov: float = 0.75) -> DataFrame:
    """Hits that are similar and long enough. cutoffs: marker_id, marker_cutoff, used unless aln_mapid is given."""
    if aln_mapid is not None:
        similar = hits.filter(F.col("pid") >= aln_mapid)
    else:
        similar = hits.join(cutoffs, "marker_id").filter(F.col("pid") >= F.col("marker_cutoff")).drop("marker_cutoff")
    return similar.filter(F.col("aln") / F.col("qlen") >= aln_cov)


def best_hits(hits: DataFrame) -> DataFrame:
    """All hits of the largest score of each read, with their number n_best; ties stay."""
    read = Window.partitionBy("query")
    best = hits.withColumn("top", F.max("score").over(read)).filter(F.col("score") == F.col("top")).drop("top")
    return best.withColumn("n_best", F.count(F.lit(1)).over(read))


def marker_support(counts: DataFrame, *, marker_reads: float = 2, marker_covered: int = 2) -> DataFrame:
    """Markers with enough reads, of species with enough such markers."""
    species_rows = Window.partitionBy("species_id")  # a row a marker
    enough = counts.filter(F.col("reads") >= marker_reads).withColumn("_n", F.count(F.lit(1)).over(species_rows))
    return enough.filter(F.col("_n") >= marker_covered).drop("_n")


def unique_counts(best: DataFrame) -> DataFrame:
    """Reads and aligned bases of reads with one best hit, per species and marker."""
    return best.filter("n_best = 1").groupBy("species_id", "marker_id").agg(F.sum("aln").cast("long").alias("alnbps"), F.count(F.lit(1)).alias("reads"))


def ambiguous_weights(best: DataFrame, unique: DataFrame) -> DataFrame:
    """The share of each gene in a read with several best hits, in proportion to the unique reads of its marker.

    A gene that a read hits twice counts once, with its last alignment; without any unique reads
    all genes share alike. This is the expected outcome of the weighted draw; see drawn for one draw.
    """
    genes = best.filter("n_best > 1").groupBy("query", "target", "species_id", "marker_id").agg(F.max_by("aln", "aln_no").alias("aln"))
    weighed = genes.join(unique.select("species_id", "marker_id", F.col("reads").alias("weight")), ["species_id", "marker_id"], "left").withColumn("weight", F.coalesce("weight", F.lit(0)))
    read = Window.partitionBy("query")
    total = F.sum("weight").over(read)
    return weighed.withColumn("share", F.when(total > 0, F.col("weight") / total).otherwise(F.lit(1) / F.count(F.lit(1)).over(read)))


def ambiguous_expected(shares: DataFrame) -> DataFrame:
    return shares.groupBy("species_id", "marker_id").agg(F.sum(F.col("share") * F.col("aln")).alias("alnbps"), F.sum("share").alias("reads"))


def drawn(shares: DataFrame) -> DataFrame:
    """One gene of each read, drawn with its shares by a number that the read's name fixes."""
    u = F.conv(F.substring(F.md5("query"), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    up_to = F.sum("share").over(Window.partitionBy("query").orderBy("target").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = shares.withColumn("up_to", up_to).withColumn("u", u)
    first = Window.partitionBy("query").orderBy(F.when(F.col("up_to") > F.col("u"), 0).otherwise(1), "target")
    return ahead.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place", "up_to", "u")


def markers_info(gene_map: DataFrame, gene_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the marker map (species_id, gene_id, gene_length, marker_id, ...) whose gene is in the sequence file, and per species and marker marker_length and gene_ids.

    Every copy of a marker adds to its length. gene_ids are joined with commas, in order of id.
    """
    genes = gene_map.join(gene_ids.select("gene_id").distinct(), "gene_id", "left_semi")
    markers = genes.groupBy("species_id", "marker_id").agg(F.sum("gene_length").alias("marker_length"), F.array_join(F.array_sort(F.collect_list("gene_id")), ",").alias("gene_ids"))
    return genes, markers


def covered_counts() -> list[Column]:
    has = lambda c: F.col(f"{c}_reads") > 0
    return [F.count_if(has("uniq") | has("ambi")).alias("total_covered"), F.count_if(has("uniq")).alias("unique_covered"), F.count_if(has("ambi")).alias("ambiguous_covered"), F.count(F.lit(1)).alias("total_marker_counts")]


def covered_markers(matrix: DataFrame) -> DataFrame:
    """Per species: markers with unique, with ambiguous and with any reads, and all there are."""
    return matrix.groupBy("species_id").agg(*covered_counts())


def marker_matrix(markers: DataFrame, unique: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """All markers (species_id, marker_id, marker_length) of the species found, with reads and bases of both kinds, 0 where none."""
    found = unique.select("species_id").union(ambiguous.select("species_id")).distinct()
    key = ["species_id", "marker_id"]
    uniq = unique.select(*key, F.col("reads").alias("uniq_reads"), F.col("alnbps").alias("uniq_alnbps"))
    ambi = ambiguous.select(*key, F.col("reads").alias("ambi_reads"), F.col("alnbps").alias("ambi_alnbps"))
    numbers = ["uniq_reads", "uniq_alnbps", "ambi_reads", "ambi_alnbps"]
    all_ = markers.join(found, "species_id", "left_semi").join(uniq, key, "left").join(ambi, key, "left").na.fill(0, numbers)
    return all_.withColumn("coverage", (F.col("uniq_alnbps") + F.col("ambi_alnbps")) / F.col("marker_length"))


def support_matrix(best: DataFrame, lengths: DataFrame, *, marker_reads: float = 2, marker_covered: int = 2) -> DataFrame:
    """marker_matrix from the best hits of reads, of markers with enough support.

    Hits and the counts of markers (a row a species and marker) are written where two steps need
    them, so that hits are joined and ranked once, whatever is made of them.
    """
    enough = {"marker_reads": marker_reads, "marker_covered": marker_covered}
    best = kept(best.select("query", "aln_no", "target", "species_id", "marker_id", "aln", "n_best"))
    unique = kept(marker_support(unique_counts(best), **enough))
    expected = ambiguous_expected(ambiguous_weights(best, unique)).withColumn("reads", F.round("reads", 6))
    return kept(marker_matrix(lengths, unique, kept(marker_support(expected, **enough))))


def species_profile(matrix: DataFrame, *, covered: bool = False) -> DataFrame:
    """Per species: reads, coverage over all markers, median coverage with zeros, relative abundance, share of markers hit uniquely, and with covered what covered_markers counts."""
    base = F.col("uniq_alnbps") + F.col("ambi_alnbps")
    rows = matrix.groupBy("species_id").agg(
        F.sum(F.col("uniq_reads") + F.col("ambi_reads")).alias("marker_read_counts"),
        F.median("coverage").alias("median_marker_coverage"),
        (F.sum(base) / F.sum("marker_length")).alias("marker_coverage"),
        (F.count_if(F.col("uniq_reads") > 0) / F.count(F.lit(1))).alias("unique_fraction_covered"),
        *(covered_counts() if covered else []),
    )
    # A row per species: the grand total is one more aggregate beside it, not a window over a single partition.
    total = rows.agg(F.sum("marker_coverage").alias("total"))
    return rows.crossJoin(F.broadcast(total)).withColumn("marker_relative_abundance", F.coalesce(F.try_divide("marker_coverage", "total"), F.lit(0.0))).drop("total")


def above_thresholds(profile: DataFrame, thresholds: dict[str, float], ids: Sequence[str] | None = None) -> DataFrame:
    """Rows above every threshold (strictly; -1 switches one off), of the ids given."""
    for column, least in thresholds.items():
        if least != -1:
            profile = profile.filter(F.col(column) > least)
    return profile if ids is None else profile.filter(F.col("species_id").isin(list(ids)))


def select_species(profile: DataFrame, thresholds: dict[str, float], ids: Sequence[str] | None = None) -> DataFrame:
    """Species above every threshold (strictly; -1 switches one off), of the ids given, largest first by the first column."""
    return above_thresholds(profile, thresholds, ids).orderBy(F.desc(next(iter(thresholds))), "species_id")


def merge_profiles(profiles: DataFrame, *, min_cov: float = 1.0) -> DataFrame:
    """Statistics of each species over all samples; a sample without it counts as 0.

    profiles: sample_name, species_id, marker_relative_abundance, median_marker_coverage. Absent
    samples are not laid out: zeros are padded in the median of each species.
    """
    n = profiles.agg(F.countDistinct("sample_name").alias("samples"))
    each = profiles.groupBy("species_id").agg(
        F.collect_list(F.col("marker_relative_abundance").cast("double")).alias("abundance"),
        F.collect_list(F.col("median_marker_coverage").cast("double")).alias("coverage"),
        F.count_if(F.col("median_marker_coverage") >= min_cov).alias("sample_counts"),
    )

    def stats(values: str):
        padded = F.array_sort(F.concat(values, F.array_repeat(F.lit(0.0), (F.col("samples") - F.size(values)).cast("int"))))
        low, high = F.floor((F.col("samples") - 1) / 2).cast("int"), F.floor(F.col("samples") / 2).cast("int")
        mean = F.aggregate(F.array_sort(values), F.lit(0.0), lambda a, x: a + x) / F.col("samples")
        return (F.get(padded, low) + F.get(padded, high)) / 2, mean

    full = each.crossJoin(F.broadcast(n))
    (ma, aa), (mc, ac) = stats("abundance"), stats("coverage")
    return full.select("species_id", ma.alias("median_abundance"), aa.alias("mean_abundance"), mc.alias("median_coverage"), ac.alias("mean_coverage"), "sample_counts")
