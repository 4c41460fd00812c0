"""Quality control of alignments and of mates.

Columns of an alignment: query_name, ref_id, is_read1, is_reverse, is_secondary, is_proper_pair,
mapping_quality, template_length, reference_start, reference_end (half open), query_length,
query_alignment_start, query_alignment_end, query_sequence, query_qualities (array), nm,
aligned_pairs (array of qpos, rpos; null for gaps), reference_sequence (of the aligned range).
is_qcfail, is_duplicate and is_unmapped may be there too; where one lacks, no alignment is so.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignments import SLIM, full, slim
from .intervals import overlap_length

#: Flags of alignments whose bases add no depth.
UNCOUNTED = ("is_secondary", "is_qcfail", "is_duplicate", "is_unmapped")


def mean_quality(qualities: Column) -> Column:
    return F.aggregate(qualities, F.lit(0).cast("long"), lambda a, x: a + x) / F.size(qualities)


def keep_read(*, aln_mapid: float = 94.0, aln_readq: float = 20.0, aln_mapq: int = 10, aln_cov: float = 0.75) -> Column:
    """Condition: primary, similar enough, of good bases, mapped uniquely enough, aligned over enough of its length."""
    aligned = F.col("query_alignment_end") - F.col("query_alignment_start")
    return (
        ~F.col("is_secondary")
        & (F.try_divide(100 * (aligned - F.col("nm")), aligned) >= aln_mapid)
        & (mean_quality(F.col("query_qualities")) >= aln_readq)
        & (F.col("mapping_quality") >= aln_mapq)
        & (F.try_divide(aligned, F.col("query_length")) >= aln_cov)
    )


def owner(reads: DataFrame) -> list[str]:
    return [c for c in ("sample_name", "species_id") if c in reads.columns]


def single_reads(reads: DataFrame, *, analysis_ready: bool = False, ordinal: str = "row_no", columns: Sequence[str] | None = None, **limits) -> DataFrame:
    """Reads that pass, the last one of each read and mate (of a sample and species, if those are columns); all of them if they are ready for analysis.

    columns: what is wanted of each beside its key, all columns if not given; nothing else is shuffled. Names seldom meet
    within a task, so reads are dealt by key first and sorted there once, not before the shuffle too.
    """
    kept = reads if analysis_ready else reads.filter(keep_read(**limits))
    key = [*owner(reads), "query_name", "is_read1"]
    rest = [c for c in reads.columns if c not in key and (columns is None or c in columns)]
    kept, slimmed = (slim(kept), [*SLIM, *[c for c in rest if c != "aligned_pairs"]]) if "aligned_pairs" in rest else (kept, rest)
    dealt = kept.select(*dict.fromkeys([*key, ordinal, *slimmed])).repartition(*key)
    return dealt.groupBy(*key).agg(F.max_by(F.struct(*slimmed), ordinal).alias("row")).select(*key, *full("row", rest))


def covering(reads: DataFrame) -> Column:
    """Condition: an alignment whose bases count at sites. Others (secondary, failed, duplicate, unmapped) still count as reads."""
    flags = [F.coalesce(F.col(c), F.lit(False)) for c in UNCOUNTED if c in reads.columns]
    return ~reduce(lambda a, b: a | b, flags, F.lit(False))


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with these columns, worked out here and nowhere else: conditions on them, or further uses, do not work them out again."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def walk(read: str, overlap: Column, forward: bool) -> Column:
    """Struct of mismatches inside and outside the mates' overlap, and of gaps of the reference inside."""
    c = lambda name: F.col(f"{read}.{name}")
    boundary = c("query_alignment_end") - overlap if forward else c("query_alignment_start") + overlap - 1
    inside = lambda p: p["qpos"].isNotNull() & ((p["qpos"] >= boundary) if forward else (p["qpos"] <= boundary))
    ref = lambda p: F.upper(F.substring(c("reference_sequence"), p["rpos"] - c("reference_start") + 1, F.lit(1)))
    base = lambda p: F.upper(F.substring(c("query_sequence"), p["qpos"] + 1, F.lit(1)))
    same = lambda p: F.coalesce((ref(p) == base(p)) & ref(p).isin("A", "C", "G", "T"), F.lit(False))
    # One pass over the pairs: 1 differs inside, 2 outside, 3 inside where the reference has a gap.
    mark = lambda p: F.when(same(p), 0).when(~inside(p), 2).when(p["rpos"].isNull(), 3).otherwise(1)
    n = lambda marks, *kinds: F.size(F.filter(marks, lambda m: m.isin(*kinds)))
    counted = F.transform(F.array(F.transform(c("aligned_pairs"), mark)), lambda marks: F.struct(n(marks, 1, 3).alias("inside"), n(marks, 2).alias("outside"), n(marks, 3).alias("gaps")))
    return F.get(counted, F.lit(0))


def arbitrated(fwd: Column, rev: Column) -> Column:
    """Qualities of two overlapping ends: the higher stays, the lower becomes 0; at a tie the forward read keeps its own."""
    pairs = F.arrays_zip(fwd.alias("f"), rev.alias("r"))
    keeps = lambda x: x["r"].isNull() | (x["f"] >= x["r"])
    return F.struct(
        F.transform(F.filter(pairs, lambda x: x["f"].isNotNull()), lambda x: F.when(keeps(x), x["f"]).otherwise(0)).alias("fwd"),
        F.transform(F.filter(pairs, lambda x: x["r"].isNotNull()), lambda x: F.when(x["f"].isNull() | (x["f"] < x["r"]), x["r"]).otherwise(0)).alias("rev"),
    )


def proper_pairs(
    reads: DataFrame, *, aln_mapid: float = 94.0, aln_mapq: int = 10, aln_readq: float = 20.0, aln_cov: float = 0.75, fragment_length: int = 1000, fragment_ratio: float = 3.0, ordinal: str = "row_no"
) -> DataFrame:
    """Pairs of mates on a contig that pass together: ref_id, query_name, fwd, rev (structs), overlap, identity, and fwd_qualities and rev_qualities, settled where the mates overlap.

    Where reads have a sample and species, pairs are theirs. Reads are dealt by name, so that last_pairs finds the pairs of a name together.
    """
    key = [*owner(reads), "ref_id", "query_name"]
    rest = [c for c in reads.columns if c not in key]
    row = F.struct(*SLIM, *[c for c in rest if c != "aligned_pairs"])
    slim_row = lambda side: F.max_by(row, F.when(F.col("is_reverse") == (side == "slim_rev"), F.col(ordinal))).alias(side)
    pairs = (
        slim(reads)
        .filter(~F.col("is_secondary") & F.col("is_proper_pair"))
        .repartition(*[c for c in key if c != "ref_id"])
        .groupBy(*key)
        .agg(slim_row("slim_fwd"), slim_row("slim_rev"))
        .filter("slim_fwd IS NOT NULL AND slim_rev IS NOT NULL")
    )
    aligned = lambda s: F.col(f"{s}.query_alignment_end") - F.col(f"{s}.query_alignment_start")
    both = F.concat("slim_fwd.query_qualities", "slim_rev.query_qualities")
    good = pairs.filter(
        (mean_quality(both) >= aln_readq)
        & (F.greatest("slim_fwd.mapping_quality", "slim_rev.mapping_quality") >= aln_mapq)
        & (F.abs("slim_fwd.template_length") <= fragment_length * fragment_ratio)
        & ((aligned("slim_fwd") + aligned("slim_rev")) / (F.col("slim_fwd.query_length") + F.col("slim_rev.query_length")) >= aln_cov)
    )
    whole = once(good, fwd=F.struct(*full("slim_fwd", rest)), rev=F.struct(*full("slim_rev", rest))).drop("slim_fwd", "slim_rev")
    on_ref = overlap_length(F.col("fwd.reference_start"), F.col("fwd.reference_end") - 1, F.col("rev.reference_start"), F.col("rev.reference_end") - 1)
    gaps = F.size(F.filter("fwd.aligned_pairs", lambda p: p["rpos"].isNotNull() & (p["rpos"] >= F.col("fwd.reference_end") - F.col("on_ref")) & p["qpos"].isNull()))
    met = once(once(whole, on_ref=on_ref), mates=F.col("on_ref") - gaps)
    walked = once(met, f=walk("fwd", F.col("mates"), True), r=walk("rev", F.col("mates"), False))
    meets = F.col("mates") != 0
    shared = walked.withColumn("overlap", F.when(meets, F.col("mates") - F.col("f.gaps")).otherwise(0)).filter(~meets | (F.abs(F.col("f.inside") - F.col("r.inside")) <= 1))
    length = aligned("fwd") + aligned("rev") - F.col("overlap")
    mismatches = F.col("fwd.nm") + F.when(meets, F.col("r.outside")).otherwise(F.col("rev.nm"))
    kept = shared.withColumn("identity", F.try_divide(100 * (length - mismatches), length)).filter(F.col("identity") >= aln_mapid)
    b1 = F.greatest(F.col("fwd.query_alignment_end") - F.col("overlap"), F.lit(0))
    b2 = F.col("rev.query_alignment_start") + F.col("overlap")
    fq, rq = F.col("fwd.query_qualities"), F.col("rev.query_qualities")
    tail, head = F.slice(fq, b1 + 1, F.greatest(F.size(fq) - b1, F.lit(0))), F.slice(rq, F.lit(1), F.greatest(b2, F.lit(0)))
    # Positions beyond the shorter of both ends keep their quality.
    n = F.least(F.size(tail), F.size(head))
    settled = arbitrated(F.slice(tail, F.lit(1), n), F.slice(head, F.lit(1), n))
    fwd_new = F.concat(F.slice(fq, F.lit(1), b1), settled["fwd"], F.slice(tail, n + 1, F.size(tail)))
    rev_new = F.concat(settled["rev"], F.slice(rq, n + 1, F.size(rq)))
    return kept.select(*key, "fwd", "rev", "overlap", "identity", F.when(meets, fwd_new).otherwise(fq).alias("fwd_qualities"), F.when(meets, rev_new).otherwise(rq).alias("rev_qualities"))


def last_pairs(pairs: DataFrame, *, ordinal: str = "row_no") -> DataFrame:
    """Of pairs of one name (of a sample and species) the last: where mates pass together on several contigs, the later contig has them."""
    key = [*owner(pairs), "query_name"]
    rest = [c for c in pairs.columns if c not in key]
    return pairs.groupBy(*key).agg(F.max_by(F.struct(*rest), F.greatest(f"fwd.{ordinal}", f"rev.{ordinal}")).alias("pair")).select(*key, "pair.*")


def mates(pairs: DataFrame) -> DataFrame:
    """The reads of pairs that passed, one row each, with the qualities settled between mates."""
    side = lambda s, q: F.struct(F.col(f"{s}.*"), F.col(q).alias("settled"))
    key = [*owner(pairs), "ref_id", "query_name"]
    both = pairs.select(*key, F.explode(F.array(side("fwd", "fwd_qualities"), side("rev", "rev_qualities"))).alias("read"))
    flat = both.select(*key, "read.*")
    return flat.withColumn("query_qualities", F.col("settled")).drop("settled")


def mapped_targets(reads: DataFrame, target: str = "ref_id") -> DataFrame:
    """Targets that any read is aligned to, with how many."""
    return reads.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("reads"))


def contig_reads(reads: DataFrame, keep: Column) -> DataFrame:
    """Aligned and mapped reads of each contig (of a sample and species, if those are columns)."""
    return reads.groupBy(*owner(reads), "ref_id").agg(F.count(F.lit(1)).alias("aligned_reads"), F.count_if(keep).alias("mapped_reads"))
