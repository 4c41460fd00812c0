"""Joins of genomic intervals, both ends included unless said otherwise.

Both sides are dealt into bins of the contig and joined on them, so that a range condition
becomes an equi-join that shuffles and spills like any other; a pair is kept in the one bin
where the later of both starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequences import degeneracy_table

BIN = 2048


def binned(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    low, high = F.floor(F.col(start) / width), F.floor(F.greatest(F.col(start), F.col(end)) / width)
    return df.withColumn("first_bin", low).withColumn("bin", F.explode(F.sequence(low, high)))


def overlap_join(genes: DataFrame, hits: DataFrame, *, contig: str = "contig_id", width: int = BIN) -> DataFrame:
    """All pairs on a contig with a.start < b.end and b.start < a.end; columns of hits that genes has too get the suffix _hit.

    Both have start_pos and end_pos. Ranges that only touch at one base do not overlap.
    """
    renamed = hits.select(contig, *[F.col(c).alias(f"{c}_hit" if c in genes.columns else c) for c in hits.columns if c != contig])
    left = binned(genes, "start_pos", "end_pos", width)
    right = binned(renamed, "start_pos_hit", "end_pos_hit", width).withColumnRenamed("first_bin", "first_bin_hit")
    pairs = left.join(right, [contig, "bin"]).filter((F.col("start_pos") < F.col("end_pos_hit")) & (F.col("start_pos_hit") < F.col("end_pos")))
    return pairs.filter(F.col("bin") == F.greatest("first_bin", "first_bin_hit")).drop("bin", "first_bin", "first_bin_hit")


def trim_overlaps(features: DataFrame) -> DataFrame:
    """Adds trimmed_start: a feature that starts before its predecessor on the contig ends starts behind it instead.

    The predecessor is the one before in order of start, then gene_id, with its own end; a nested
    feature so gets an empty range and holds no position.
    """
    before = F.lag("end_pos").over(Window.partitionBy("contig_id").orderBy("start_pos", "gene_id"))
    return features.withColumn("trimmed_start", F.when(F.col("start_pos") <= before, before + 1).otherwise(F.col("start_pos")))


def sites_in_genes(sites: DataFrame, features: DataFrame, *, width: int = BIN) -> DataFrame:
    """Sites (contig_id, ref_pos) with the feature whose trimmed range holds them; without one, its columns are null.

    Where two ranges hold a site, the later start counts. Features are dealt like the sites: a small file may hold many, so they are not broadcast.
    """
    ranges = binned(trim_overlaps(features).filter("trimmed_start <= end_pos"), "trimmed_start", "end_pos", width).drop("first_bin").hint("merge")
    at = sites.withColumn("bin", F.floor(F.col("ref_pos") / width))
    held = at.join(ranges, ["contig_id", "bin"]).filter(F.col("ref_pos").between(F.col("trimmed_start"), F.col("end_pos")))
    last = held.groupBy("contig_id", "ref_pos").agg(F.max_by(F.struct(*[c for c in features.columns if c != "contig_id"]), F.struct("trimmed_start", "gene_id")).alias("gene"))
    return sites.join(last, ["contig_id", "ref_pos"], "left").select(*sites.columns, "gene.*")


def annotate_sites(placed: DataFrame, sequences: DataFrame) -> DataFrame:
    """Adds locus_type, site_type, amino_acids to placed sites. sequences: gene_id, sequence, oriented start to stop.

    A site outside genes is IGR; other than in a CDS, or where the codon has other letters than
    A, C, G, T, there is no site_type. Codons follow the feature's own start and end, not the trimmed.

    The sites of a gene meet its sequence once, as one array (a gene has no more sites than bases), and
    both are dealt by gene: how small a file of sequences is does not say that they can be broadcast;
    what a codon gives is looked up in a table of all 384 codons, places and strands.
    """
    rest = [c for c in placed.columns if c != "gene_id"]
    within_gene = F.when(F.col("strand") == "+", F.col("ref_pos") - F.col("start_pos")).otherwise(F.col("end_pos") - F.col("ref_pos"))
    coding = (F.col("gene_type") == "CDS") & F.col("gene_id").isNotNull()
    per_gene = placed.filter(coding).groupBy("gene_id").agg(F.collect_list(F.struct(*rest, within_gene.cast("int").alias("within_gene"))).alias("sites"))
    codon_of = lambda s: F.struct(s.alias("site"), F.substring(F.col("sequence"), s["within_gene"] - s["within_gene"] % 3 + 1, F.lit(3)).alias("codon"))
    codons = per_gene.join(sequences.select("gene_id", "sequence").hint("merge"), "gene_id", "left").select("gene_id", F.explode(F.transform("sites", codon_of)).alias("s"))
    flat = codons.select("gene_id", *[F.col(f"s.site.{c}").alias(c) for c in rest], F.col("s.codon").alias("codon"), (F.col("s.site.within_gene") % 3).alias("within"))
    table = placed.sparkSession.createDataFrame(degeneracy_table(), "codon string, within int, codon_strand string, site_type string, amino_acids string")
    called = flat.join(F.broadcast(table), (flat["codon"] == table["codon"]) & (flat["within"] == table["within"]) & (flat["strand"] == table["codon_strand"]), "left").select(*placed.columns, "site_type", "amino_acids")
    others = placed.filter(~F.coalesce(coding, F.lit(False))).withColumns({"site_type": F.lit(None).cast("string"), "amino_acids": F.lit(None).cast("string")})
    return called.unionByName(others).withColumn("locus_type", F.coalesce("gene_type", F.lit("IGR")))


def overlap_length(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(start_a, start_b) + 1)
