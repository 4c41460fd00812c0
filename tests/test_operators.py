"""Golden rows, properties and edge cases of the operators."""

from pyspark.sql import functions as F

from helixframe.functions import alleles, sequences
from helixframe.operators import chunks, cnv, intervals, pangenome, pileup, readqc, selectors, snv, species
from helixframe.sources import readers, writers
from helixframe.streaming import incremental


def site_rows(spark, *counts):
    rows = [("s", "sp", "c", i, "A", *c, sum(c)) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "sample_name string, species_id string, ref_id string, ref_pos long, ref_allele string, count_a long, count_c long, count_g long, count_t long, depth long")


def test_calls_in_one_sample(spark):
    got = pileup.advanced(site_rows(spark, (0, 0, 0, 11), (0, 5, 0, 8), (0, 6, 0, 6), (1, 0, 0, 0)), snp_maf=0.1).orderBy("ref_pos").collect()
    assert [(r.major_allele, r.minor_allele, round(r.major_allele_freq, 3), round(r.minor_allele_freq, 3), r.allele_counts) for r in got] == [("T", "T", 1.0, 0.0, 1), ("T", "C", 0.615, 0.385, 2), ("C", "T", 0.5, 0.5, 2)]


def test_unambiguous_sites(spark):
    got = pileup.deep_sites(site_rows(spark, (3, 3, 0, 0), (3, 2, 0, 0), (0, 0, 0, 4)), ignore_ambiguous=True)
    assert {r.ref_pos for r in got.collect()} == {1, 2}


def test_summary_arithmetic():
    assert round(15271923 / 2322823, 3) == 6.575 and round(2322823 / 2762447, 3) == 0.841


def test_noise_floor_and_ratio(spark):
    quiet = snv.noise_floor(site_rows(spark, (2, 3, 0, 10))).first()
    assert (quiet.count_a, quiet.count_c, quiet.count_t, quiet.depth) == (0, 3, 10, 13)
    samples = spark.createDataFrame([("s", "sp", 5.0, 1)], "sample_name string, species_id string, mean_depth double, samples_count long")
    kept = snv.site_filter(site_rows(spark, (15, 0, 0, 0), (16, 0, 0, 0)), samples)
    assert [r.ref_pos for r in kept.collect()] == [0]  # a ratio of 3 exactly stays


def test_prevalence_needs_two_samples(spark):
    pooled = spark.createDataFrame([("sp", "c", 1, "A", 9, 10, 50, 20, 0, 0, 9, 1, 0, 0)], "species_id string, ref_id string, ref_pos long, ref_allele string, count_samples long, samples_count long, rc_a long, rc_c long, rc_g long, rc_t long, sc_a long, sc_c long, sc_g long, sc_t long")
    assert snv.prevalent(pooled).count() == 1  # 0.9 exactly is common
    assert snv.population(pooled).count() == 0  # the second allele is in one sample alone
    assert snv.population(pooled, method="abundance").first().snp_type == "bi"
    assert snv.population(pooled, snp_types=("any",)).first().snp_type == "mono"


def test_frequency_of_absent_sample(spark):
    sites = site_rows(spark, (10, 5, 0, 0)).withColumn("samples_count", F.lit(2))
    called = spark.createDataFrame([("sp", "c", 0, "A", "A", "C")], "species_id string, ref_id string, ref_pos long, ref_allele string, major_allele string, minor_allele string")
    samples = spark.createDataFrame([("s", "sp"), ("t", "sp")], "sample_name string, species_id string")
    got = {r.sample_name: (r.sample_depth, r.sample_maf) for r in snv.sample_frequencies(called, sites, samples).collect()}
    assert got == {"s": (15, 5 / 15), "t": (0, -1.0)}


def test_pileup_from_alignments(spark):
    pairs = [(0, 4), (1, 5), (None, 6), (2, 7), (3, None)]
    reads = spark.createDataFrame([("s", "sp", "c", "ACGT", [30, 10, 40, 40], "r", pairs)], "sample_name string, species_id string, ref_id string, query_sequence string, query_qualities array<int>, query_name string, aligned_pairs array<struct<qpos:int,rpos:int>>")
    genome = spark.createDataFrame([("c", "TTTTACAGT")], "ref_id string, sequence string")
    for block in (2, 3, 2048):
        counted = pileup.pileup(pileup.explode_alignments(reads), base_quality=20)
        got = pileup.with_reference(counted, genome, block=block).orderBy("ref_pos").collect()
        assert [(r.ref_pos, r.ref_allele, r.count_a, r.count_g, r.depth) for r in got] == [(5, "A", 1, 0, 1), (8, "G", 0, 1, 1)]
    assert pileup.with_reference(counted.withColumn("ref_pos", F.col("ref_pos") + 100), genome).count() == 0


def test_region_is_half_open(spark):
    rows = spark.createDataFrame([("c", p) for p in (10, 11, 20, 21)] + [("d", 15)], "ref_id string, ref_pos long")
    assert sorted(r.ref_pos for r in pileup.region(rows, "c", 10, 20).collect()) == [11, 20]


HIT = "query string, aln_no int, target long, species_id string, marker_id string, pid double, aln int, qlen int, score double"


def test_best_hits_keep_ties(spark):
    rows = [("r1", 1, 1, "a", "m", 99.0, 100, 100, 50.0), ("r1", 2, 2, "b", "m", 99.0, 100, 100, 50.0), ("r1", 3, 3, "b", "m", 99.0, 100, 100, 40.0), ("r2", 1, 1, "a", "m", 99.0, 100, 100, 50.0), ("r2", 2, 1, "a", "m", 99.0, 90, 100, 50.0)]
    best = species.best_hits(spark.createDataFrame(rows, HIT))
    assert {(r.query, r.target, r.aln_no, r.n_best) for r in best.collect()} == {("r1", 1, 1, 2), ("r1", 2, 2, 2), ("r2", 1, 1, 2), ("r2", 1, 2, 2)}
    shares = species.ambiguous_weights(best, species.unique_counts(best))
    assert {(r["query"], r.target, r.share, r.aln) for r in shares.collect()} == {("r1", 1, 0.5, 100), ("r1", 2, 0.5, 100), ("r2", 1, 1.0, 90)}
    assert species.drawn(shares).count() == 2


def test_empty_inputs(spark):
    hits = spark.createDataFrame([], HIT)
    best = species.best_hits(species.passing_hits(hits, aln_mapid=94.0))
    assert species.unique_counts(best).count() == 0
    assert pileup.advanced(site_rows(spark, (0, 0, 0, 0)).limit(0)).count() == 0


def test_merge_counts_absent_samples_as_zero(spark):
    rows = [("s1", "a", 0.5, 2.0), ("s2", "a", 0.7, 4.0), ("s2", "b", 0.3, 0.5), ("s3", "b", 1.0, 3.0)]
    got = {r.species_id: r for r in species.merge_profiles(spark.createDataFrame(rows, "sample_name string, species_id string, marker_relative_abundance double, median_marker_coverage double")).collect()}
    assert (got["a"].median_coverage, got["a"].mean_coverage, got["a"].sample_counts) == (2.0, 2.0, 2)
    assert (got["b"].median_coverage, got["b"].sample_counts) == (0.5, 1)


def test_marker_votes(spark):
    rows = [("c1", "m"), ("c1", "m"), ("c1", None), ("c2", "m"), ("c2", None), ("c3", "m"), ("c3", "n"), ("c4", None)]
    genes = spark.createDataFrame(rows, "centroid string, marker_id string")
    got = {r.centroid: (round(r.marker_density, 3), r.marker_id) for r in pangenome.marker_votes(genes, "centroid").collect()}
    assert got == {"c1": (0.667, "m"), "c2": (0.5, None), "c3": (0.0, None), "c4": (0.0, None)}


def test_copy_number_without_markers(spark):
    genes = spark.createDataFrame([("s", "sp", 1, 2, 2, 10, 0.1, None), ("s", "sp", 2, 2, 2, 10, 0.3, "m")], "sample_name string, species_id string, cluster_id long, aligned_reads long, mapped_reads long, total_depth long, mean_depth double, marker_id string")
    markers = spark.createDataFrame([("m",), ("n",), ("o",)], "marker_id string")
    depth = cnv.marker_depth(genes, markers)
    assert depth.first().marker_depth == 0.0  # two of three markers have none
    assert {r.copy_number for r in cnv.copy_numbers(genes, depth).collect()} == {0.0}


def test_presence_threshold(spark):
    got = cnv.presence(spark.createDataFrame([(0.289325,), (0.35,)], "copy_number double")).collect()
    assert [r.presabs for r in got] == [0, 1]


def test_overlap_join_equals_brute_force(spark):
    a = [(i, i % 3, i * 700 % 9000 + 1, i * 700 % 9000 + 1 + i * 37 % 5000) for i in range(60)]
    b = [(i, i % 3, i * 911 % 9500 + 1, i * 911 % 9500 + 60 + i % 7) for i in range(60)] + [(100, 0, 1, 1), (101, 1, 701, 701)]
    genes = spark.createDataFrame(a, "gene_id long, contig_id long, start_pos long, end_pos long")
    hits = spark.createDataFrame(b, "hit_id long, contig_id long, start_pos long, end_pos long")
    got = sorted((r.gene_id, r.hit_id) for r in intervals.overlap_join(genes, hits, width=512).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])


def test_nested_gene_holds_nothing(spark):
    features = spark.createDataFrame([(1, 1, 10, 100, "+", "CDS"), (2, 1, 20, 50, "+", "CDS"), (3, 1, 60, 150, "-", "tRNA")], "gene_id long, contig_id long, start_pos long, end_pos long, strand string, gene_type string")
    sites = spark.createDataFrame([(1, p) for p in (5, 30, 55, 120, 151)] + [(2, 10)], "contig_id long, ref_pos long")
    got = {(r.contig_id, r.ref_pos): r.gene_id for r in intervals.sites_in_genes(sites, features).collect()}
    assert got == {(1, 5): None, (1, 30): 1, (1, 55): 1, (1, 120): 3, (1, 151): None, (2, 10): None}


def test_codons(spark):
    table = {r[:3]: r[3:] for r in sequences.degeneracy_table()}
    assert len(table) == 384
    assert table["GCT", 2, "+"] == ("4D", "A,A,A,A") and table["ATG", 0, "+"] == ("2D", "M,L,V,L") and table["GCT", 2, "-"][0] == "4D"
    df = spark.createDataFrame([("GCT",), ("ATG",), ("GCN",)], "codon string")
    assert [r.aa for r in df.select(sequences.translate_codon(F.col("codon")).alias("aa")).collect()] == ["A", "M", None]
    placed = spark.createDataFrame([("g", "c", 5, "+", 3, 11, "CDS"), ("g", "c", 11, "+", 3, 11, "CDS"), ("h", "c", 20, "-", 12, 20, "CDS"), ("t", "c", 30, "+", 30, 40, "tRNA"), (None, "c", 99, None, None, None, None)], "gene_id string, contig_id string, ref_pos long, strand string, start_pos long, end_pos long, gene_type string")
    genes = spark.createDataFrame([("g", "GCTNNNATG"), ("h", "ATGAAATAG")], "gene_id string, sequence string")
    got = {r.ref_pos: (r.locus_type, r.site_type, r.amino_acids) for r in intervals.annotate_sites(placed, genes).collect()}
    # The base at 11 is the last of the third codon, ATG; that at 20 the first of the minus strand's ATG.
    assert got == {5: ("CDS", "4D", "A,A,A,A"), 11: ("CDS", "3D", "I,I,M,I"), 20: ("CDS", "2D", "L,V,L,M"), 30: ("tRNA", None, None), 99: ("IGR", None, None)}


def test_site_ids_are_parsed_from_the_right(spark):
    s = spark.createDataFrame([("gnl|P|c_1|17|A",)], "site string").select(alleles.parse_site_id(F.col("site")).alias("s")).first().s
    assert (s.ref_id, s.ref_pos, s.ref_allele) == ("gnl|P|c_1", 17, "A")


def test_chunks_cover_each_base_once(spark):
    contigs = spark.createDataFrame([("a", 999), ("b", 1000), ("c", 2500), ("d", 1)], "contig_id string, length long")
    for plan in (chunks.run_chunks(contigs, chunk_size=1000), chunks.merge_chunks(contigs, chunk_size=1000)):
        covered = {}
        for r in plan.collect():
            covered.setdefault(r.contig_id, []).append((r.start, r.end))
        for name, length in (("a", 999), ("b", 1000), ("c", 2500), ("d", 1)):
            at = 0
            for start, end in sorted(covered[name]):
                assert start == at < end
                at = end
            assert at == length


def test_packed_chunks(spark):
    pieces = spark.createDataFrame([("sp", f"c{i}", n) for i, n in enumerate((900, 700, 300, 90, 10))], "species_id string, contig_id string, length long")
    by = {}
    for r in chunks.pack_contigs(pieces, chunk_size=1000).collect():
        by.setdefault(r.chunk_id, []).append(r.length)
    assert all(sum(v) <= 1000 for v in by.values()) and sorted(n for v in by.values() for n in v) == [10, 90, 300, 700, 900]
    assert sorted(by[0]) == [10, 90, 900] and sorted(by[1]) == [300, 700]


READ = (
    "row_no int, ref_id string, query_name string, is_reverse boolean, is_secondary boolean, is_proper_pair boolean, mapping_quality int, template_length int, reference_start int, reference_end int, query_length int,"
    "query_alignment_start int, query_alignment_end int, query_sequence string, query_qualities array<int>, nm int, aligned_pairs array<struct<qpos:int,rpos:int>>, reference_sequence string"
)


def mate(row, name, reverse, start, sequence, quality, nm, reference, proper=True, tlen=20):
    n = len(sequence)
    return (row, "c", name, reverse, False, proper, 40, tlen, start, start + n, n, 0, n, sequence, quality, nm, [(i, start + i) for i in range(n)], reference)


def test_proper_pairs(spark):
    ref = "ACGTACGTACGTACGTACGT"
    rows = [
        mate(1, "far", False, 0, ref[:8], [30] * 8, 0, ref[:8]), mate(2, "far", True, 12, ref[12:], [30] * 8, 0, ref[12:]),
        mate(3, "near", False, 0, ref[:12], [30] * 12, 0, ref[:12]), mate(4, "near", True, 8, ref[8:], [20, 40] * 6, 0, ref[8:]),
        mate(5, "orphan", False, 0, ref[:8], [30] * 8, 0, ref[:8]),
        mate(6, "odd", False, 0, ref[:12], [30] * 12, 0, ref[:12]), mate(7, "odd", True, 8, "TTTT" + ref[12:], [30] * 12, 3, ref[8:]),
        mate(8, "long", False, 0, ref[:8], [30] * 8, 0, ref[:8], tlen=9000), mate(9, "long", True, 12, ref[12:], [30] * 8, 0, ref[12:], tlen=-9000),
        mate(10, "improper", False, 0, ref[:8], [30] * 8, 0, ref[:8], proper=False), mate(11, "improper", True, 12, ref[12:], [30] * 8, 0, ref[12:], proper=False),
    ]
    got = {r.query_name: r for r in readqc.proper_pairs(spark.createDataFrame(rows, READ)).collect()}
    assert set(got) == {"far", "near"}
    assert got["far"].overlap == 0 and got["near"].overlap == 4 and got["near"].identity == 100.0
    # In the four shared bases the better quality stays and the other becomes 0.
    assert got["near"].fwd_qualities == [30] * 8 + [30, 0, 30, 0] and got["near"].rev_qualities == [0, 40, 0, 40] + [20, 40] * 4


def test_id_slices(spark):
    ids = spark.createDataFrame([("GCF_3",), ("GCF_10",), ("GCF_11",)], "id string")
    assert {r.id for r in ids.filter(selectors.id_slice(F.col("id"), "1:2")).collect()} == {"GCF_3", "GCF_11"}
    assert ids.filter(selectors.id_slice(F.col("id"), "GCF_3, GCF_10")).count() == 2
    assert ids.filter(selectors.id_slice(F.col("id"), "all")).count() == 3


def test_fixed_decimals_round_like_python(spark):
    values = [0.0] + [k / 2000 for k in range(2, 4001)] + [1.15, 2.5, 1234567.0005]
    got = writers.formatted(spark.createDataFrame([(v,) for v in values], "x double"), 3).collect()
    assert [r.x for r in got] == [f"{v:.3f}" for v in values]


def test_fasta_and_fastq(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">g1 first\nACGT\nAC\n>g2\nTT\n")
    (tmp_path / "b.fastq").write_text("@r1 x\nACGT\n+\n@@II\n@r2\nAC\n+\nII\n")
    got = {r.id: (r.seq, r.qual, r.length) for r in readers.fastx(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fastq")]).collect()}
    assert got == {"g1": ("ACGTAC", None, 6), "g2": ("TT", None, 2), "r1": ("ACGT", "@@II", 4), "r2": ("AC", "II", 2)}
    writers.write_fasta(readers.fastx(spark, str(tmp_path / "a.fa")), str(tmp_path / "out"), seq_column="seq")
    assert {r.id: r.seq for r in readers.fastx(spark, str(tmp_path / "out")).collect()} == {"g1": "ACGTAC", "g2": "TT"}


def test_text_formats(spark, tmp_path):
    (tmp_path / "x.gff").write_text("##gff\nc1\tProdigal:2\tCDS\t3\t20\t.\t+\t0\tID=g_1;locus_tag=g_1\nc1\tprokka\tgene\t3\t20\t.\t+\t0\tID=g_1_gene\nc1\tx\tCDS\t1\t2\t.\t-\t0\tnote=none\n>seq\nACGT\n")
    assert [(r.gene_id, r.start, r.end, r.strand) for r in readers.gff_features(spark, str(tmp_path / "x.gff")).collect()] == [("g_1", 3, 20, "+")]
    (tmp_path / "x.hmm").write_text("# c\ng1 - 100 B1 - 50 0 0 0 1 1 0 1e-9 0 0 1 50 11 90 1 100 x\n")
    r = readers.hmm_hits(spark, str(tmp_path / "x.hmm")).first()
    assert (r.gene_id, r.marker_id, r.evalue, r.qcov, r.tcov) == ("g1", "B1", 1e-9, 1.0, 1.0)
    (tmp_path / "x.clstr").write_text(">Cluster 0\n0\t120nt, >g1... *\n1\t100nt, >g2... at +/99%\n>Cluster 1\n0\t90nt, >g3... *\n")
    got = {(r.cluster, r.gene_id, r.length, r.is_representative) for r in readers.clstr(spark, str(tmp_path / "x.clstr")).collect()}
    assert got == {(0, "g1", 120, True), (0, "g2", 100, False), (1, "g3", 90, True)}
    (tmp_path / "mge.csv").write_text("# a\nmge_no,name,prediction,type,contig,start,stop\n1,n,p,t,c1 len=3,5,9\n")
    r = readers.annotation(spark, str(tmp_path / "mge.csv"), "mobile").first()
    assert (r.contig_id, r.start_pos, r.end_pos) == ("c1", 5, 9)
    (tmp_path / "res.tab").write_text("Resistance gene\tIdentity\tAlignment Length/Gene Length\tCoverage\tPosition in reference\tContig\tPosition in contig\tPhenotype\tAccession no.\ntet\t99\t1/1\t100\t1..9\tc2\t12..345\tx\ty\n")
    r = readers.annotation(spark, str(tmp_path / "res.tab"), "resistance").first()
    assert (r.contig_id, r.start_pos, r.end_pos) == ("c2", 12, 345)
    (tmp_path / "e.ann").write_text("## c\n#query\tEC\ng1\t1.1\n## end\n")
    assert readers.orthologs(spark, str(tmp_path / "e.ann")).first().asDict() == {"query": "g1", "EC": "1.1"}
    gene = spark.createDataFrame([("gnl|Prokka|GCF_1.1_7|provirus_3_13983_1",)], "g string").select(readers.contig_of_gene(F.col("g"), True).alias("c")).first().c
    assert gene == "gnl|Prokka|GCF_1.1_7"


def test_typed_tsv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("name\tage\theight\ntommy\t9\t120\nmasha\t7\t122\n")
    rows = readers.tsv(spark, str(tmp_path / "t.tsv"), "name string, age int, height double", columns=["height", "name"]).collect()
    assert {tuple(r) for r in rows} == {(120.0, "tommy"), (122.0, "masha")}


def test_lines_are_numbered_across_splits(spark, tmp_path):
    """Splits are dealt out by size: the number of a line is its place in its file all the same."""
    files = {"a.txt": 3000, "b.txt": 11, "c.txt": 900, "empty.txt": 0}
    for name, n in files.items():
        (tmp_path / name).write_text("".join(f"{name} {i} {'x' * (i % 37)}\n" for i in range(n)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert len(got) == sum(files.values())
    assert all(r.value.startswith(f"{r.path.rsplit('/', 1)[1]} {r.line_no} ") for r in got)


def test_fastq_with_empty_reads_and_marks_in_qualities(spark, tmp_path):
    plain = [("r1", "ACGT", "@+>I"), ("r2", "", ""), ("r3", "GG", "++"), ("r4", "T", "@")]
    (tmp_path / "p.fastq").write_text("".join(f"@{n} c\n{s}\n+{n}\n{q}\n" for n, s, q in plain) + "@cut\nAC\n")
    for multiline in (False, True):
        got = readers.fastx(spark, str(tmp_path / "p.fastq"), multiline=multiline).collect()
        assert sorted((r.id, r.seq, r.qual, r.length) for r in got) == sorted((*r, len(r[1])) for r in plain)
    (tmp_path / "m.fastq").write_text("@a\nACG\nTT\n+\n@+I\nII\n@b\nC\n+\n@\n")
    assert sorted((r.id, r.seq, r.qual) for r in readers.fastx(spark, str(tmp_path / "m.fastq"), multiline=True).collect()) == [("a", "ACGTT", "@+III"), ("b", "C", "@")]


def test_orthologs_of_empty_files(spark, tmp_path):
    (tmp_path / "none.annotations").write_text("")
    (tmp_path / "some.annotations").write_text("## x\n#query\tPFAMs\ng1\tq\n")
    assert readers.orthologs(spark, str(tmp_path / "none.annotations")).columns[-1] == "PFAMs"
    got = readers.orthologs(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0]["query"] == "g1" and got[0]["PFAMs"] == "q"


def test_checked_joins(spark):
    import pytest

    rows = lambda *ids: spark.createDataFrame([(i, 1) for i in ids], "k string, n int")
    assert pangenome.joined_one_to_one(rows("a", "b"), rows("b", "a").withColumnRenamed("n", "m"), "k").count() == 2
    for left, right in ((("a",), ("a", "b")), (("a", "b"), ("a",)), (("a", "a"), ("a",))):
        with pytest.raises(Exception, match="tables differ in k"):
            pangenome.joined_one_to_one(rows(*left), rows(*right).withColumnRenamed("n", "m"), "k").count()
    genes = spark.createDataFrame([("g",)], "gene_id string")
    with pytest.raises(Exception, match="no length of gene g"):
        pangenome.gene_info(genes, spark.createDataFrame([], "gene_id string, gene_length int"), spark.createDataFrame([], "gene_id string, marker_id string")).collect()
    with pytest.raises(ValueError):
        pangenome.annotation_column("other")


def test_mates_settle_where_they_overlap(spark):
    """Two mates of four bases over the same three: the better base counts once; a tie is the forward read's."""
    read = "query_name string, ref_id string, is_read1 boolean, is_reverse boolean, is_secondary boolean, is_proper_pair boolean, mapping_quality int, template_length int, reference_start int, reference_end int, query_length int, query_alignment_start int, query_alignment_end int, query_sequence string, query_qualities array<int>, nm int, aligned_pairs array<struct<qpos:int,rpos:int>>, reference_sequence string, row_no long"
    mate = lambda k, start, seq, quals: ("q", "c", k == 0, k == 1, False, True, 40, 5, start, start + 4, 4, 0, 4, seq, quals, 0, [(i, start + i) for i in range(4)], seq, k)
    reads = spark.createDataFrame([mate(0, 0, "ACGT", [40, 30, 30, 20]), mate(1, 1, "CGTA", [30, 20, 35, 40])], read)
    pair = readqc.proper_pairs(reads).first()
    assert (pair.overlap, pair.identity) == (3, 100.0) and list(pair.fwd_qualities) == [40, 30, 30, 0] and list(pair.rev_qualities) == [0, 0, 35, 40]
    assert readqc.proper_pairs(reads.filter("row_no = 0")).count() == 0
    got = {(r.query_name, r.is_reverse): list(r.query_qualities) for r in readqc.mates(readqc.proper_pairs(reads)).collect()}
    assert got == {("q", False): [40, 30, 30, 0], ("q", True): [0, 0, 35, 40]}


def test_frequencies_of_locus_types(spark):
    rows = spark.createDataFrame([(1, "CDS"), (2, "IGR"), (3, "tRNA")], "ref_pos int, locus_type string")
    assert {r.ref_pos for r in snv.of_locus(rows, locus_types=("CDS", "tRNA")).collect()} == {1, 3} and snv.of_locus(rows).count() == 3


def test_samples_that_arrive_one_by_one(spark, tmp_path):
    """Counts pooled over a stream of samples end where those of all samples at once are."""
    rows = spark.range(400).select(
        F.concat(F.lit("s"), F.col("id") % 5).alias("sample_name"), F.lit("sp").alias("species_id"), F.lit("c").alias("ref_id"), F.floor(F.col("id") / 10).alias("ref_pos"), F.lit("A").alias("ref_allele"),
        (F.col("id") % 7).alias("count_a"), (F.col("id") % 3).alias("count_c"), F.lit(0).cast("long").alias("count_g"), F.lit(1).cast("long").alias("count_t"), F.lit(5).cast("long").alias("samples_count"),
    )
    for k in range(5):
        rows.filter(F.col("sample_name") == f"s{k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    running = incremental.pooled_stream(stream).writeStream.outputMode("complete").format("memory").queryName("pooled_sites").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    running.awaitTermination()
    want = snv.pooled(rows).drop("samples_count")
    found = spark.table("pooled_sites").select(*[F.col(c).cast(t) for c, t in want.dtypes])
    assert found.count() == want.count() > 10
    assert found.exceptAll(want).isEmpty()
