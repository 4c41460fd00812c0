"""Gene copy numbers of a sample, and matrices of genes over samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GENE = ("sample_name", "species_id", "cluster_id")


def gene_depth(observed: DataFrame, clusters: DataFrame, *, base_quality: int = 15, total_depth: int = 1) -> DataFrame:
    """Reads and depth of each gene cluster in each sample.

    observed: sample_name, species_id, cluster_id, read_id, base_qual of aligned bases; clusters:
    cluster_id, gene_length, marker_id. The mean is over the whole length. Clusters with fewer reads
    than total_depth, or no depth, are left out.
    """
    per_read = observed.groupBy(*GENE, "read_id").agg(F.max("base_qual").alias("best"), F.count_if(F.col("base_qual") >= base_quality).alias("bases"))
    rows = per_read.groupBy(*GENE).agg(F.count(F.lit(1)).alias("aligned_reads"), F.count_if(F.col("best") >= base_quality).alias("mapped_reads"), F.sum("bases").alias("total_depth"))
    rows = rows.filter((F.col("aligned_reads") >= total_depth) & (F.col("mapped_reads") >= total_depth) & (F.col("total_depth") > 0))
    return rows.join(clusters, "cluster_id").withColumn("mean_depth", F.col("total_depth") / F.col("gene_length"))


def marker_depth(genes: DataFrame, markers: DataFrame, *, decimals: int = 6) -> DataFrame:
    """Median over all markers of a species' depth in a sample; markers without genes count as 0.

    markers: the distinct marker_id that there are. Depths are rounded first, as tables of them are.
    """
    found = genes.select("sample_name", "species_id").distinct()
    sums = genes.filter("marker_id IS NOT NULL").groupBy("sample_name", "species_id", "marker_id").agg(F.round(F.sum("mean_depth"), decimals).alias("depth"))
    # Zeros are counted, not laid out: the universe of markers is one number beside each group.
    n = markers.filter("marker_id IS NOT NULL").agg(F.countDistinct("marker_id").alias("markers"))
    lists = found.join(sums.groupBy("sample_name", "species_id").agg(F.collect_list("depth").alias("depths")), ["sample_name", "species_id"], "left").crossJoin(F.broadcast(n))
    depths = F.coalesce("depths", F.array().cast("array<double>"))
    padded = F.array_sort(F.concat(depths, F.array_repeat(F.lit(0.0), (F.col("markers") - F.size(depths)).cast("int"))))
    at = lambda x: F.coalesce(F.get(padded, F.floor(x).cast("int")), F.lit(0.0))
    return lists.select("sample_name", "species_id", ((at((F.col("markers") - 1) / 2) + at(F.col("markers") / 2)) / 2).alias("marker_depth"))


def copy_numbers(genes: DataFrame, depths: DataFrame) -> DataFrame:
    """Depth of each gene over the median of markers, 0 where that is 0."""
    joined = genes.join(depths, ["sample_name", "species_id"])
    return joined.withColumn("copy_number", F.when(F.col("marker_depth") > 0, F.try_divide("mean_depth", "marker_depth")).otherwise(0.0))


def gene_summary(genes: DataFrame, depths: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per sample and species; sizes: species_id, pangenome_size."""
    rows = genes.groupBy("sample_name", "species_id").agg(F.count(F.lit(1)).alias("covered_genes"), F.sum("aligned_reads").alias("aligned_reads"), F.sum("mapped_reads").alias("mapped_reads"), (F.sum("mean_depth") / F.count(F.lit(1))).alias("mean_depth"))
    return rows.join(sizes, "species_id").join(depths, ["sample_name", "species_id"]).withColumn("fraction_covered", F.col("covered_genes") / F.col("pangenome_size"))


def remap(genes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Genes under a coarser cluster. mapping: cluster_id, cluster_out, one row per cluster_id."""
    return genes.join(mapping, "cluster_id")


def cluster_sums(genes: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Copy number, depth and reads of each output cluster and sample, the members' sums; of relevant samples only if given."""
    if samples is not None:
        genes = genes.join(samples.select("sample_name", "species_id"), ["sample_name", "species_id"], "left_semi")
    return genes.groupBy("sample_name", "species_id", "cluster_out").agg(F.sum("copy_number").alias("copy_number"), F.sum("mean_depth").alias("depth"), F.sum("mapped_reads").alias("reads"))


def presence(sums: DataFrame, *, min_copy: float = 0.35) -> DataFrame:
    return sums.withColumn("presabs", (F.col("copy_number") >= min_copy).cast("int"))
