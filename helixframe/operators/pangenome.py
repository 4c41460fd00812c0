"""Curation of a pangenome: cleaning, clusters and their properties, annotation, pruning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequences import ambiguous, genome_of

LENGTHS = {"max": F.max, "median": F.median, "mean": F.avg}


def clean_genes(genes: DataFrame, *, length: int = 200) -> DataFrame:
    """Genes (gene_id, sequence) longer than length, without N or X, whose id is real; sequences in capitals."""
    kept = genes.filter((F.length("sequence") > length) & ~ambiguous(F.col("sequence")) & ~F.col("gene_id").isin("", "|"))
    return kept.withColumn("sequence", F.upper("sequence")).withColumn("gene_length", F.length("sequence"))


def clean_contigs(contigs: DataFrame, *, length: int = 1000) -> DataFrame:
    return contigs.filter(F.length("sequence") >= length)


def split_ambiguous(centroids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Centroids with plain bases only, and the others."""
    odd = ambiguous(F.col("sequence"))
    return centroids.filter(~odd), centroids.filter(odd)


def xref_clusters(first: DataFrame, coarser: dict[str, DataFrame]) -> DataFrame:
    """Every gene with the centroids of its centroid.

    first: gene_id, centroid_99. coarser: column name -> gene_id, centroid_id of centroid_99 genes.
    See checked_centroids for the rules that clusters keep.
    """
    for name, level in coarser.items():
        first = first.join(level.select(F.col("gene_id").alias("centroid_99"), F.col("centroid_id").alias(name)), "centroid_99")
    return first


def uclust_members(uclust: DataFrame) -> DataFrame:
    """gene_id, centroid_id from a table of cluster records: S rows are centroids, H rows their members."""
    return uclust.filter(F.col("type").isin("S", "H")).select("gene_id", F.when(F.col("type") == "S", F.col("gene_id")).otherwise(F.col("centroid_id")).alias("centroid_id"))


def cluster_counts(genes: DataFrame, level: str) -> DataFrame:
    return genes.groupBy(level).agg(F.count(F.lit(1)).alias("gene_counts"))


def cluster_lengths(genes: DataFrame, level: str, how: str = "max") -> DataFrame:
    return genes.groupBy(level).agg(LENGTHS[how]("gene_length").alias("cluster_length"))


def length_stats(genes: DataFrame, level: str) -> DataFrame:
    n = F.col("gene_length")
    return genes.groupBy(level).agg(F.avg(n).alias("mean_length"), F.median(n).alias("median_length"), F.stddev_samp(n).alias("std_length"), F.min(n).alias("min_length"), F.max(n).alias("max_length"))


def stacked_genomes(genes: DataFrame, level: str) -> DataFrame:
    """The genomes of each cluster, once each."""
    return genes.select(level, genome_of(F.col("gene_id")).alias("genome_id")).distinct()


def cluster_prevalence(genes: DataFrame, level: str) -> DataFrame:
    """Distinct genomes of each cluster, and their share of all genomes of the table."""
    pairs = stacked_genomes(genes, level)
    total = pairs.agg(F.countDistinct("genome_id").alias("genomes"))
    return pairs.groupBy(level).agg(F.count(F.lit(1)).alias("genome_counts")).crossJoin(F.broadcast(total)).select(level, "genome_counts", (F.col("genome_counts") / F.col("genomes")).alias("genome_prevalence"))


def marker_votes(genes: DataFrame, level: str, *, majority: float = 0.5) -> DataFrame:
    """The marker most genes of a cluster have: marker_density is its share of all genes, 0 at a tie; the id only above majority."""
    by_marker = genes.groupBy(level, "marker_id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("marker_id").isNotNull()
    top = by_marker.groupBy(level).agg(F.sum("n").alias("genes"), F.max(F.when(known, F.col("n"))).alias("most"), F.sort_array(F.collect_list(F.when(known, F.struct("n", "marker_id"))), asc=False).alias("votes"))
    clear = F.col("most").isNotNull() & (F.size(F.filter("votes", lambda v: v["n"] == F.col("most"))) == 1)
    density = F.when(clear, F.col("most") / F.col("genes")).otherwise(0.0)
    return top.select(level, density.alias("marker_density"), F.when(density > majority, F.get("votes", F.lit(0))["marker_id"]).alias("marker_id"))


def cluster_info(genes: DataFrame, level: str, *, majority: float = 0.5) -> DataFrame:
    """One row per cluster that has its centroid among the genes: its coarser centroids, counts, prevalence, length, marker vote. One aggregation has all but the vote."""
    others = [c for c in genes.columns if c.startswith("centroid_") and c != level]
    own = F.max(F.when(F.col("gene_id") == F.col(level), F.struct(F.lit(1).alias("_"), *others))).alias("own")
    genome = genome_of(F.col("gene_id"))
    counts = genes.groupBy(level).agg(F.countDistinct(genome).alias("genome_counts"), F.count(F.lit(1)).alias("gene_counts"), F.max("gene_length").alias("cluster_length"), own)
    total = genes.agg(F.countDistinct(genome).alias("genomes"))  # a row
    found = counts.filter("own IS NOT NULL").crossJoin(F.broadcast(total)).select(level, *[F.col(f"own.{c}").alias(c) for c in others], "genome_counts", (F.col("genome_counts") / F.col("genomes")).alias("genome_prevalence"), "gene_counts", "cluster_length")
    return found.join(marker_votes(genes, level, majority=majority), level, "left")


def cluster_levels(genes: DataFrame, levels: Sequence[str], *, majority: float = 0.5) -> DataFrame:
    """level, centroid_id and what cluster_info says of it, for several levels at once.

    Each gene counts at every level in one aggregation, and its marker in another: two shuffles for any number of levels.
    """
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.col(x).alias("centroid_id")) for x in levels]))
    rows = genes.select("gene_id", "gene_length", "marker_id", genome_of(F.col("gene_id")).alias("genome_id"), each.alias("in")).select("in.*", "gene_id", "gene_length", "marker_id", "genome_id")
    own = F.max(F.col("gene_id") == F.col("centroid_id")).alias("own")
    counts = rows.groupBy("level", "centroid_id").agg(F.countDistinct("genome_id").alias("genome_counts"), F.count(F.lit(1)).alias("gene_counts"), F.max("gene_length").alias("cluster_length"), own)
    total = genes.agg(F.countDistinct(genome_of(F.col("gene_id"))).alias("genomes"))  # a row
    votes = marker_votes(rows.withColumn("cluster", F.struct("level", "centroid_id")), "cluster", majority=majority).select("cluster.*", "marker_density", "marker_id")
    found = counts.filter("own").drop("own").crossJoin(F.broadcast(total)).withColumn("genome_prevalence", F.col("genome_counts") / F.col("genomes")).drop("genomes")
    return found.join(votes, ["level", "centroid_id"], "left")


def pruned_centroids(clusters: DataFrame, coarse: DataFrame, *, how: str = "max", cutoff: float = 0.4, remove_singletons: bool = False) -> DataFrame:
    """Centroids of the finest level that are at least cutoff as long as their cluster at 95 is by how, and whose cluster at 75 remains.

    clusters: centroid_99, centroid_95, centroid_75, gene_length; coarse: centroid_75, gene_counts, genome_counts, genome_prevalence.
    """
    remaining = without_singletons(coarse) if remove_singletons else coarse
    return prune_short(clusters, "centroid_95", how=how, cutoff=cutoff).join(remaining.select("centroid_75").distinct(), "centroid_75", "left_semi")


def lift_to_genome(genes: DataFrame, level: str, genome: str) -> DataFrame:
    """Genes of one genome with their centroids."""
    return genes.filter(genome_of(F.col("gene_id")) == genome).select("gene_id", level)


def annotation_flags(genes: DataFrame, annotations: dict[str, DataFrame]) -> DataFrame:
    """Adds gene_is_<name>, 1 where the annotation (gene_id) has the gene. All annotations are brought together by gene once."""
    tagged = [hits.select("gene_id", F.lit(name).alias("name")) for name, hits in annotations.items()]
    each = [F.max((F.col("name") == name).cast("int")).alias(f"gene_is_{name}") for name in annotations]
    flags = reduce(DataFrame.unionByName, tagged).groupBy("gene_id").agg(*each)
    return genes.join(flags, "gene_id", "left").withColumns({f"gene_is_{name}": F.coalesce(f"gene_is_{name}", F.lit(0)) for name in annotations})


def annotation_ratios(flagged: DataFrame, level: str, names: list[str]) -> DataFrame:
    return flagged.groupBy(level).agg(*[F.avg(f"gene_is_{n}").alias(f"{n}_ratio") for n in names])


def prune_short(centroids: DataFrame, parent: str, *, how: str = "max", cutoff: float = 0.4) -> DataFrame:
    """Centroids at least cutoff as long as their parent cluster is. centroids: gene_length and the parent's id."""
    lengths = centroids.groupBy(parent).agg(LENGTHS[how]("gene_length").alias("parent_length"))
    return centroids.join(lengths, parent).filter(F.col("gene_length") >= F.col("parent_length") * cutoff).drop("parent_length")


def without_singletons(clusters: DataFrame) -> DataFrame:
    """Clusters other than single genes of one genome that few genomes have."""
    return clusters.filter(~((F.col("gene_counts") == 1) & (F.col("genome_prevalence") < 0.1) & (F.col("genome_counts") == 1)))


def best_per_key(hits: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key in an order."""
    return hits.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("place = 1").drop("place")


def marker_hits(hits: DataFrame, *, evalue: float = 1e-5, coverage: float = 0.0) -> DataFrame:
    """The best gene of each marker: least e-value, then the first row. hits: marker_id, gene_id, evalue, qcov, tcov, row_no."""
    good = hits.filter((F.col("evalue") <= evalue) & (F.least("qcov", "tcov") >= coverage))
    return best_per_key(good, ["marker_id"], ["evalue", "row_no"])


#: The column that each kind of annotation fills. The last two are named the other way round than their contents suggest, and so are the files that others read.
FLAG_OF = {"genomad_virus": "phage", "genomad_plasmid": "plasmid", "mefinder": "amr", "resfinder": "me"}
#: What is kept of functional annotation. Column names of the file.
ORTHOLOG_COLUMNS = ("COG_category", "EC", "KEGG_Pathway", "Description", "PFAMs")


def annotation_column(kind: str, by: str = "gene") -> str:
    if kind not in FLAG_OF:
        raise ValueError(f"no annotation of kind {kind}")
    return f"{by}_is_{FLAG_OF[kind]}"


def gene_info(genes: DataFrame, lengths: DataFrame, gene_map: DataFrame) -> DataFrame:
    """Genes with gene_length and marker_id; a gene without marker has an empty one, a gene without length is an error.

    lengths: gene_id, gene_length; gene_map: gene_id, marker_id. A gene counts once in either.
    """
    known = lengths.groupBy("gene_id").agg(F.max("gene_length").alias("gene_length"))
    marker = gene_map.groupBy("gene_id").agg(F.max("marker_id").alias("marker_id"))
    joined = genes.join(known, "gene_id", "left").join(marker, "gene_id", "left")
    length = F.coalesce("gene_length", F.raise_error(F.concat(F.lit("no length of gene "), "gene_id")).cast("int"))
    return joined.withColumn("gene_length", length).withColumn("marker_id", F.coalesce("marker_id", F.lit("")))


def with_orthologs(clusters: DataFrame, level: str, orthologs: DataFrame) -> DataFrame:
    """Clusters with the functional annotation of their centroid, null without one; repeated rows of it count once."""
    rows = orthologs.select(F.col("query").alias(level), *ORTHOLOG_COLUMNS).distinct()
    return clusters.join(rows, level, "left")


def or_error(condition: Column, *said: Column | str) -> Column:
    """A condition for filter() that lets all rows pass: where it does not hold, the job ends with this error."""
    message = F.concat(*[F.lit(x) if isinstance(x, str) else F.coalesce(x.cast("string"), F.lit("null")) for x in said])
    return F.when(condition, True).otherwise(F.raise_error(message).cast("boolean"))


def joined_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left with the columns of right; the job that uses it ends with an error if a key is missing on either side or occurs twice.

    Both sides are brought to a row a key, which needs no shuffle where they are grouped by it, and the join itself shows what lacks.
    """
    sides = []
    for rows, name in ((left, "l"), (right, "r")):
        rest = [c for c in rows.columns if c != key]
        sides.append(rows.groupBy(key).agg(F.first(F.struct(*rest) if rest else F.lit(0)).alias(f"_{name}"), F.count(F.lit(1)).alias(f"_{name}_n")))
    both = sides[0].join(sides[1], key, "full_outer").filter(or_error((F.coalesce("_l_n", F.lit(0)) == 1) & (F.coalesce("_r_n", F.lit(0)) == 1), f"tables differ in {key}: ", F.col(key)))
    columns = [F.col(f"_{n}.{c}").alias(c) for rows, n in ((left, "l"), (right, "r")) for c in rows.columns if c != key]
    return both.select(key, *columns)


def checked_centroids(members: DataFrame) -> DataFrame:
    """Members (gene_id, centroid_id) as they are; the job ends with an error where a centroid is not a member of its own cluster, or a gene occurs twice."""
    once = members.groupBy("gene_id").agg(F.count(F.lit(1)).alias("_n"), F.first("centroid_id").alias("centroid_id")).filter(or_error(F.col("_n") == 1, "gene occurs twice: ", F.col("gene_id")))
    own = members.filter(F.col("gene_id") == F.col("centroid_id")).select("centroid_id", F.lit(1).alias("_own")).distinct()
    return once.join(own, "centroid_id", "left").filter(or_error(F.col("_own").isNotNull(), "centroid is not its own: ", F.col("centroid_id"))).select("gene_id", "centroid_id")


def unique_keys(rows: DataFrame, key: str) -> DataFrame:
    """Rows as they are; the job ends with an error where a key occurs twice."""
    rest = [c for c in rows.columns if c != key]
    once = rows.groupBy(key).agg(F.first(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n")).filter(or_error(F.col("_n") == 1, f"{key} occurs twice: ", F.col(key)))
    return once.select(key, "_row.*").select(*rows.columns)


def genes_on_contigs(features: DataFrame, contig_lengths: DataFrame) -> DataFrame:
    """Gene features with the length of their contig; features of unknown contigs are left out."""
    return features.join(contig_lengths.select("contig_id", "contig_length"), "contig_id")


def orthologs_on_contigs(orthologs: DataFrame, centroids: DataFrame, features: DataFrame, contig_lengths: DataFrame) -> DataFrame:
    """Functional annotation of centroids (centroid_99) with their place on a contig."""
    placed = genes_on_contigs(features.join(centroids.select(F.col("centroid_99").alias("gene_id")).distinct(), "gene_id", "left_semi"), contig_lengths)
    return orthologs.join(placed.withColumnRenamed("gene_id", "query"), "query")


def members_of(genes: DataFrame, level: str, centroid: str) -> DataFrame:
    """Genes of a cluster other than its centroid."""
    return genes.filter((F.col(level) == centroid) & (F.col("gene_id") != centroid))


def sequences_of(sequences: DataFrame, ids: DataFrame, key: str = "gene_id") -> DataFrame:
    return sequences.join(ids.select(key), key, "left_semi")


def marker_genes(hits: DataFrame, sequences: DataFrame) -> DataFrame:
    """The map of best marker hits (gene_id, marker_id): gene_id, gene_length, marker_id and marker_gene, its bases in capitals. A hit without sequence is an error."""
    joined = hits.select("gene_id", "marker_id").join(sequences.select("gene_id", "sequence"), "gene_id", "left")
    gene = F.upper(F.coalesce("sequence", F.raise_error(F.concat(F.lit("no sequence of gene "), "gene_id")).cast("string")))
    return joined.select("gene_id", F.length(gene).alias("gene_length"), "marker_id", gene.alias("marker_gene"))


def composed(first: DataFrame, second: DataFrame) -> DataFrame:
    """Members (gene_id, centroid_id) under the centroids of their centroids, which second has (gene_id, centroid_id)."""
    return first.join(second.select(F.col("gene_id").alias("centroid_id"), F.col("centroid_id").alias("new_id")), "centroid_id").select("gene_id", F.col("new_id").alias("centroid_id"))


def original_names(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """A column of short names replaced by the original ones (names: short, original); a name without original stays."""
    return rows.join(names.select(F.col("short").alias(column), "original"), column, "left").withColumn(column, F.coalesce("original", column)).drop("original")


def species_of_genes(genes: DataFrame, toc: DataFrame, species: DataFrame | None = None) -> DataFrame:
    """Genes with the species of their genome (toc: genome, species); only of the species given, if any are."""
    known = toc.select(F.col("genome").alias("genome_id"), F.col("species").alias("species_id"))
    if species is not None:
        known = known.join(species.select("species_id").distinct(), "species_id", "left_semi")
    return genes.withColumn("genome_id", genome_of(F.col("gene_id"))).join(known, "genome_id")


def representatives(toc: DataFrame) -> DataFrame:
    """species, representative and the number of genomes of each species."""
    return toc.groupBy("species").agg(F.max(F.when(F.col("genome_is_representative") == 1, F.col("genome"))).alias("representative"), F.count(F.lit(1)).alias("genomes"))


def replace_centroids(members: DataFrame, renamed: DataFrame) -> DataFrame:
    """Members (gene_id, centroid_id) with new centroids where renamed (centroid_id, new_id) has one."""
    return members.join(renamed, "centroid_id", "left").withColumn("centroid_id", F.coalesce("new_id", "centroid_id")).drop("new_id")
