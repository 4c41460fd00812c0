"""What queries shuffle, and results on inputs that the smallest tables have not."""

import os

import pytest

from helixframe.operators import coverage, readqc
from helixframe.plans import bindings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def dealt(df) -> list[str]:
    """Names of the columns of each shuffle."""
    found, seen = [], [df._jdf.queryExecution().executedPlan()]
    while seen:
        at = seen.pop()
        if at.nodeName() == "Exchange":
            found.append(at.output().mkString(" "))
        below = at.children()
        seen += [at.executedPlan()] if at.nodeName() == "AdaptiveSparkPlan" else [below.apply(k) for k in range(below.size())]
    return found


def test_reads_are_made_without_gathering_columns(spark):
    found = plan(bindings.reads(spark, SF))
    assert "collect_list" not in found and found.count("Exchange") == 1


def test_single_reads_sort_once_and_shuffle_what_is_wanted(spark):
    found = plan(readqc.single_reads(bindings.reads(spark, SF), analysis_ready=True, columns=coverage.OBSERVED))
    # One shuffle of keys of orders, one of reads; nothing is sorted before it.
    assert found.count("Exchange") == 2 and found.count("Sort [") == 1
    assert "below" not in found.split("Exchange")[1].split("\n")[0]


def test_pairs_and_last_pairs_are_dealt_once(spark):
    assert plan(readqc.last_pairs(readqc.proper_pairs(bindings.reads(spark, SF)))).count("Exchange") == 2


def test_head_reads_writes_no_file_in_one_task(spark, monkeypatch):
    from helixframe.plans import files

    found, kept = [], files.text
    monkeypatch.setattr(files, "text", lambda rows, *lines, **how: found.append((plan(rows), how)) or kept(rows, *lines, **how))
    assert [r.id for r in files.head_reads(spark, SF).collect()] == [f"g{k}" for k in sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())[:50]]
    assert "Coalesce 1" not in found[0][0] and found[0][1]["order"] == "n"


def test_means_are_added_in_file_order(spark, tmp_path):
    from pyspark.sql import functions as F

    from helixframe.plans import workflows

    values = [0.07, 0.01, 0.05, 0.04, 0.1, 0.03, 0.06] * 3
    spark.createDataFrame([(k, 1, v) for k, v in enumerate(values)], "k int, g int, v double").coalesce(1).write.parquet(str(tmp_path / "rows"))
    total = 0.0
    for v in values:
        total += v
    rows = spark.read.option("maxPartitionBytes", "64").parquet(str(tmp_path / "rows"))
    assert workflows.in_file_order(rows, "v", F.col("g")).first().mean == total / len(values)


def test_reads_travel_without_structs_of_pairs(spark):
    columns = ["ref_id", "aligned_pairs", "query_sequence", "query_qualities"]
    rows = spark.createDataFrame([("s", "q", True, 1, "k", [(0, 7), (1, None), (None, 8), None, (2, 9)], "ACG", [30] * 3, 7), ("s", "q", True, 0, "k", [], "A", [1], 3), ("s", "p", True, 2, "k", None, "A", None, None)], "sample_name string, query_name string, is_read1 boolean, row_no int, ref_id string, aligned_pairs array<struct<qpos:int,rpos:int>>, query_sequence string, query_qualities array<int>, reference_start int")
    found = readqc.single_reads(rows, analysis_ready=True, columns=columns)
    assert dealt(found) and not any("aligned_pairs" in x for x in dealt(found))
    assert found.select(*columns).schema["aligned_pairs"].dataType.simpleString() == rows.schema["aligned_pairs"].dataType.simpleString()
    got = {r.query_name: r.aligned_pairs for r in found.collect()}
    assert got["p"] is None and [tuple(p) for p in got["q"]] == [(0, 7), (1, None), (None, 8), (None, None), (2, 9)]


def test_pairs_travel_without_structs_and_are_worked_out_once(spark):
    found = readqc.proper_pairs(bindings.reads(spark, SF))
    assert any("_qpos" in x for x in dealt(found)) and not any("aligned_pairs" in x for x in dealt(found))
    assert plan(found).count("Generate inline") == 4


@pytest.fixture
def no_small_tables(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_reads_are_chosen_where_they_are(spark, no_small_tables):
    from helixframe.operators import workflows

    reads = bindings.reads(spark, SF)
    found = workflows.chosen(reads, reads.groupBy("sample_name", "species_id").count(), ["count"], [10], None)
    assert "SortMergeJoin" not in plan(found) and "BroadcastHashJoin" in plan(found)


def test_features_and_sequences_are_dealt(spark):
    from helixframe.operators import intervals

    features = bindings.bind(spark, SF, "v_feat")
    sites = spark.range(50).selectExpr("id % 20 AS contig_id", "id + 1 AS ref_pos")
    found = plan(intervals.annotate_sites(intervals.sites_in_genes(sites, features), features.selectExpr("gene_id", "repeat('ACGT', 150) AS sequence")))
    assert found.count("SortMergeJoin [gene_id") == 1 and "BroadcastHashJoin [gene_id" not in found
    # Sites meet features twice: once for those in a CDS, once for the others.
    assert sum("SortMergeJoin [contig_id" in x and "bin#" in x for x in found.split("\n")) == 2


def test_genes_are_counted_before_they_meet_the_catalogue(spark, no_small_tables):
    from helixframe.plans import workflows

    assert not any("query_sequence" in x for x in dealt(workflows.gene_result(spark, SF)["genes"]))


def test_merged_samples_are_counted_once(spark):
    from helixframe.plans import workflows

    # Sites come from a file for both results, so neither counts reads into blocks again.
    found = workflows.snps(spark, SF, stored=True)
    assert all("MapInArrow" not in plan(found[name]) for name in ("pileup", "summary"))


def test_alignments_are_dealt_to_files_without_structs_of_pairs(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from helixframe.sources import bam

    written, kept = [], DataFrame.write
    monkeypatch.setattr(DataFrame, "write", property(lambda df: written.append(df) or kept.fget(df)))
    reads = bindings.reads(spark, SF).limit(200)
    bam.write_bam(reads, str(tmp_path / "bam"), [(f"k{c}", bindings.CONTIG_LENGTH) for c in range(bindings.CONTIGS)])
    monkeypatch.undo()
    columns = dealt(written[0])[0]
    assert "_rpos" in columns and not any(c in columns for c in ("aligned_pairs", "sample_name", "species_id", "row_no"))
    keys = ["query_name", "ref_id", "is_reverse"]
    shown = lambda df: sorted(df.selectExpr(*keys, "cast(aligned_pairs AS string) AS p").collect())
    assert len(shown(reads)) == 200 and shown(bam.read_bam(spark, str(tmp_path / "bam"))) == shown(reads)
