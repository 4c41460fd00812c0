"""Queries that write files of each format from the test tables and read them back: the SQL states what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pangenome, selectors
from ..sources import readers, schemas, writers
from ..sources.scratch import scratch
from .bindings import bind, with_views
from .registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(rows: DataFrame, *lines: str | Column, name: str = "", order: str | None = None) -> str:
    """Writes lines (expressions) of each row as text, row by row in order, and gives the path."""
    spark = rows.sparkSession
    cells = F.array(*[F.expr(x) if isinstance(x, str) else x for x in lines])
    path = scratch(spark) + name
    kept = rows.orderBy(order) if order else rows
    kept.select(F.array_join(cells, "\n").alias("value")).write.text(path)
    return path


def with_head(path: str, spark: SparkSession, head: str) -> list[str]:
    """The path, and that of a file of head lines."""
    first = scratch(spark)
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(first)
    return [first, path]


# ---------------------------------------------------------------- tables

FEAT = with_views("v_feat") + "x AS (SELECT 1) "


@query(FEAT + "SELECT CAST(gene_id AS VARCHAR) AS gene_id, CAST(contig_id AS VARCHAR) AS contig_id, end_pos AS \"end\" FROM v_feat")
def read_tsv(spark, sf_dir):
    """A typed table with a header: columns chosen and reordered."""
    path = scratch(spark)
    f = bind(spark, sf_dir, "v_feat")
    writers.write_tsv(f.select(F.col("gene_id").cast("string"), F.col("contig_id").cast("string"), F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "strand", "gene_type"), path)
    return readers.tsv(spark, path, schemas.GENE_FEATURES, columns=["end", "gene_id", "contig_id"]).select("gene_id", "contig_id", F.col("end").cast("int").alias("end"))


@query("SELECT p_partkey AS id, p_brand AS brand, p_retailprice AS price, CASE WHEN p_size % 5 > 0 THEN p_size END AS size FROM part WHERE p_size % 2 = 0")
def read_inferred(spark, sf_dir):
    """Types inferred from the text; an empty cell is null."""
    path = scratch(spark)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"), F.when(F.col("p_size") % 5 > 0, F.col("p_size")).alias("size"), F.col("p_size").alias("all"))
    rows.write.options(sep="\t", header=True).csv(path)
    return readers.tsv(spark, path, None).filter(F.col("all") % 2 == 0).select(F.col("id").cast("long").alias("id"), "brand", "price", "size")


@query("SELECT p_partkey AS id, printf('%.3f', p_retailprice / 7) AS price, printf('%.3f', -p_retailprice) AS negative, CASE WHEN p_partkey % 3 = 0 THEN 'None' ELSE printf('%.3f', p_size / 8) END AS size FROM part")
def write_decimals(spark, sf_dir):
    """Fixed decimals and None as the writer puts them, read as text."""
    path = scratch(spark)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") / 7).alias("price"), (-F.col("p_retailprice")).alias("negative"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size") / 8).alias("size"))
    writers.write_tsv(rows, path)
    return readers.tsv(spark, path, "id long, price string, negative string, size string")


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def write_compressed(spark, sf_dir):
    """Half of a table as gzip, half as bzip2; the ending tells the reader which."""
    rows, paths = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), []
    for k, codec in enumerate(("gzip", "bzip2")):
        paths.append(scratch(spark))
        writers.write_tsv(rows.filter(F.col("id") % 2 == k), paths[-1], compression=codec)
    return readers.tsv(spark, paths, "id long, name string")


@query("SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, printf('%.3f', l_extendedprice) AS price, l_returnflag AS flag FROM lineitem")
def write_lz4(spark, sf_dir):
    """A table as LZ4 frames, of small blocks so that a file is several splits, read line by line again."""
    path = scratch(spark) + ".lz4"
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"))
    writers.write_tsv(rows, path, compression="lz4")
    return readers.tsv(spark, path, "id long, line int, part long, price string, flag string")


@query("SELECT o_orderkey AS id, o_custkey AS contig, o_orderkey % 7 AS chunk FROM orders")
def write_chunks(spark, sf_dir):
    """One folder a chunk, read as one table: nothing has to be put together below a header."""
    path = scratch(spark)
    writers.write_partitioned(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("contig"), (F.col("o_orderkey") % 7).alias("chunk")), path, "chunk")
    return spark.read.parquet(path).select("id", "contig", F.col("chunk").cast("long").alias("chunk"))


@query("SELECT o_orderkey AS id, o_custkey AS contig, o_orderkey % 7 AS chunk FROM orders WHERE o_orderkey % 7 = 3 AND o_custkey BETWEEN 10 AND 60")
def scan_range(spark, sf_dir):
    """A chunk and a range of a partitioned table: other folders are not opened, and the range reaches the scan."""
    path = scratch(spark)
    writers.write_partitioned(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("contig"), (F.col("o_orderkey") % 7).alias("chunk")), path, "chunk")
    found = spark.read.parquet(path).filter((F.col("chunk") == 3) & F.col("contig").between(10, 60))
    return found.select("id", "contig", F.col("chunk").cast("long").alias("chunk"))


@query(with_views("v_genes") + "x AS (SELECT 1) SELECT gene_id, row_number() OVER (ORDER BY gene_id) - 1 AS line_no FROM v_genes")
def write_gene_info(spark, sf_dir):
    """Gene info in order of gene: the number of each line below the headers."""
    path = scratch(spark)
    writers.write_gene_info(bind(spark, sf_dir, "v_genes").select("gene_id", "gene_length"), path)
    lines = readers.numbered_lines(spark, path).filter(~F.col("value").startswith("gene_id"))
    gene = F.split("value", "\t")[0]
    files = lines.groupBy("path").agg(F.min(gene).alias("least"), F.max(gene).alias("most"), F.count(F.lit(1)).alias("n"))
    wide = files.alias("a").join(files.alias("b"), F.col("b.most") < F.col("a.least"), "left").groupBy("a.path").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return lines.join(wide, "path").select(gene.alias("gene_id"), (F.col("line_no") - 1 + F.col("before")).alias("line_no"))


SAMPLE_TABLES = "SELECT concat('s', l_suppkey % 4) AS sample_name, l_partkey AS site, CAST(sum(l_quantity) AS BIGINT) AS depth FROM lineitem GROUP BY 1, 2"


@query(SAMPLE_TABLES)
def read_samples(spark, sf_dir):
    """The tables of all samples that a manifest lists, in one scan."""
    return sample_tables(spark, sf_dir, "summary", "none")


@query(SAMPLE_TABLES)
def read_samples_lz4(spark, sf_dir):
    """The same from LZ4 frames."""
    return sample_tables(spark, sf_dir, "summary.lz4", "lz4")


def sample_tables(spark, sf_dir, file: str, compression: str) -> DataFrame:
    base = scratch(spark)
    rows = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 4).alias("k"), F.col("l_partkey").alias("site")).agg(F.sum("l_quantity").cast("long").alias("depth"))
    for k in range(4):
        writers.write_tsv(rows.filter(F.col("k") == k).select("site", "depth"), f"{base}/s{k}/{file}", compression=compression)
    manifest = scratch(spark)
    spark.createDataFrame([(f"s{k}", base) for k in range(4)], "sample_name string, outdir string").write.options(sep="\t", header=True).csv(manifest)
    return readers.samples(spark, manifest, file, "site long, depth long").select("sample_name", "site", "depth")


@query("SELECT concat('sp', n_nationkey) AS species_id FROM nation WHERE n_nationkey % 4 = 1 OR n_nationkey IN (2, 6)")
def read_species_list(spark, sf_dir):
    """Ids from a file and from a list."""
    path = text(table(spark, sf_dir, "nation").filter("n_nationkey % 4 = 1"), "concat('sp', n_nationkey)")
    return readers.id_list(spark, path).union(readers.id_list(spark, "sp2, sp6")).distinct()


@query("SELECT concat('G', o_orderkey) AS genome, concat('sp', o_custkey % 30) AS species, max(CASE WHEN o_orderkey = m THEN concat('G', o_orderkey) END) OVER (PARTITION BY o_custkey % 30) AS representative FROM (SELECT *, min(o_orderkey) OVER (PARTITION BY o_custkey % 30) AS m FROM orders) x")
def read_genomes(spark, sf_dir):
    """The catalogue of genomes, and the species' representative of each."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("G"), "o_orderkey").alias("genome"), F.concat(F.lit("sp"), F.col("o_custkey") % 30).alias("species"), "o_orderkey")
    first = o.groupBy("species").agg(F.min("o_orderkey").alias("m"))
    rows = o.join(first, "species").select("genome", "species", F.concat(F.lit("G"), "m").alias("representative"), (F.col("o_orderkey") == F.col("m")).cast("int").alias("genome_is_representative"))
    path = scratch(spark)
    writers.write_tsv(rows, path)
    toc = readers.genomes(spark, path)
    return toc.select("genome", "species").join(pangenome.representatives(toc).select("species", "representative"), "species")


# ---------------------------------------------------------------- sequences

SEQ = "SELECT concat('g', doc_id) AS id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS seq FROM documents"


def seqs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("g"), "doc_id").alias("id"), F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("seq"))


@query(f"SELECT id, seq, length(seq) AS length FROM ({SEQ}) s")
def read_fasta(spark, sf_dir):
    """Sequences over lines of 60."""
    path = scratch(spark)
    writers.write_fasta(seqs(spark, sf_dir).withColumn("seq", F.regexp_replace("seq", "(.{60})", "$1\n")), path)
    return readers.fastx(spark, path).select("id", "seq", F.col("length").cast("long").alias("length"))


FASTQ = f"SELECT concat(id, '_', length(seq)) AS query, seq, translate(seq, 'ACGT', '@+>I') AS qual FROM ({SEQ}) s"


def fastq(spark, sf_dir, wrap: int | None) -> str:
    """Reads whose qualities hold the marks of a record; some reads are empty."""
    fold = lambda c: F.regexp_replace(c, f"(.{{{wrap}}})(?=.)", "$1\n") if wrap else c
    qual = F.translate("seq", "ACGT", "@+>I")
    return text(seqs(spark, sf_dir), "concat('@', id, ' a comment')", fold(F.col("seq")), F.lit("+"), fold(qual), name=".fastq")


@query(FASTQ)
def read_fastq(spark, sf_dir):
    return readers.read_names(readers.fastx(spark, fastq(spark, sf_dir, None))).select("query", "seq", "qual")


@query(FASTQ)
def read_fastq_lines(spark, sf_dir):
    """Records over several lines."""
    return readers.read_names(readers.fastx(spark, fastq(spark, sf_dir, 70), multiline=True)).select("query", "seq", "qual")


@query(f"SELECT id FROM (SELECT id, row_number() OVER (ORDER BY CAST(substr(id, 2) AS BIGINT)) AS n FROM ({SEQ}) s) x WHERE n <= 50")
def head_reads(spark, sf_dir):
    """The first 50 records of files that are in order one after another: of each its first 50 at most are read, and of those the first."""
    number = lambda c: F.substring(c, 2, 20).cast("long")
    ordered = seqs(spark, sf_dir).withColumn("n", number("id"))
    path = text(ordered, "concat('@', id)", "seq", "'+'", "seq", name=".fastq", order="n")
    return readers.fastx(spark, path, max_reads=50).select("id").orderBy(number("id")).limit(50)


# ---------------------------------------------------------------- features, hits, clusters


@query(FEAT + "SELECT concat('G', gene_id) AS gene_id, concat('c', contig_id) AS contig_id, start_pos AS start, end_pos AS \"end\", strand, gene_type FROM v_feat WHERE gene_id % 9 <> 0 AND gene_id % 10 <> 0")
def read_gff(spark, sf_dir):
    """Features; those of the annotator itself and those without id go."""
    line = "concat_ws('\t', concat('c', contig_id), CASE WHEN gene_id % 9 = 0 THEN 'prokka' ELSE 'Prodigal:002006' END, gene_type, start_pos, end_pos, '.', strand, '0', CASE WHEN gene_id % 10 = 0 THEN 'product=x' ELSE concat('ID=G', gene_id, ';locus_tag=G', gene_id) END)"
    path = with_head(text(bind(spark, sf_dir, "v_feat"), line), spark, "##gff-version 3\n##sequence-region c1 1 10")
    return readers.gff_features(spark, path)


M8 = ["concat('r', l_orderkey, '_', 100 + l_linenumber) AS query", "concat('g', l_partkey) AS target", "90 + l_discount * 100 AS pid", "cast(l_quantity AS int) AS aln", "100 + l_linenumber AS qlen"]


@query("SELECT concat('r', l_orderkey, '_', 100 + l_linenumber) AS query, concat('g', l_partkey) AS target, CAST(round(90 + l_discount * 100, 3) AS DOUBLE) AS pid, CAST(l_quantity AS INT) AS aln, CAST(100 + l_linenumber AS INT) AS qlen FROM lineitem")
def read_m8(spark, sf_dir):
    """Hits without header; the read's length is in its name."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(*M8)
    line = "concat_ws('\t', query, target, round(pid, 3), aln, '1.0', '0.0', '1.0', '50.0', '1.0', '50.0', '1e-10', '80.5')"
    return readers.m8(spark, text(rows, line)).select("query", "target", F.round("pid", 3).alias("pid"), "aln", "qlen")


@query("SELECT concat('g', l_orderkey) AS gene_id, concat('m', l_linenumber) AS marker_id, CAST(l_quantity AS DOUBLE) AS evalue, (l_quantity + 1) / 200 AS qcov, (l_quantity + 11) / 100 AS tcov FROM lineitem")
def read_hmm(spark, sf_dir):
    """A domain table: columns between runs of blanks, lines with # are comments."""
    q = "cast(l_quantity AS int)"
    line = f"concat_ws('  ', concat('g', l_orderkey), '-', '200', concat('m', l_linenumber), 'acc', '100', '1', '2', '3', '1', '1', '0.1', {q}, '7', '8', '20', {q} + 30, '1', '2', '10', {q} + 10, '0.9', 'words of a description')"
    path = with_head(text(table(spark, sf_dir, "lineitem"), line), spark, "# target name\n#---")
    return readers.hmm_hits(spark, path)


GENES = with_views("v_genes") + "x AS (SELECT 1) "


@query(GENES + "SELECT gene_id, concat('G', c95 % 9, '_', c95) AS centroid_id FROM v_genes")
def read_uclust(spark, sf_dir):
    """Cluster records: members from S and H rows; C rows only sum up."""
    centre = "concat('G', c95 % 9, '_', c95)"
    line = f"concat_ws('\t', CASE WHEN gene_id = {centre} THEN 'S' ELSE 'H' END, c95, gene_length, '99.1', '+', '0', '0', '*', gene_id, CASE WHEN gene_id = {centre} THEN '*' ELSE {centre} END)"
    total = f"concat_ws('\t', 'C', c95, '3', '*', '*', '*', '*', '*', {centre}, '*')"
    return pangenome.uclust_members(readers.uclust(spark, text(bind(spark, sf_dir, "v_genes"), line, total)))


@query(GENES + ", m AS (SELECT c75, gene_id, gene_length, row_number() OVER (PARTITION BY c75 ORDER BY gene_id) - 1 AS n FROM v_genes) SELECT CAST(c75 AS INT) AS cluster, CAST(n AS INT) AS member_no, CAST(gene_length AS INT) AS length, gene_id, n = 0 AS is_representative FROM m".replace("SELECT 1) , m", "SELECT 1), m"))
def read_clstr(spark, sf_dir):
    """A listing of clusters: one heading, then its members."""
    rows = selectors.numbered(bind(spark, sf_dir, "v_genes"), ["c75"], ["gene_id"]).withColumn("n", F.col("serial") - 1)
    line = "concat(n, '\t', gene_length, 'nt, >', gene_id, '... ', CASE WHEN n = 0 THEN '*' ELSE 'at +/98.50%' END)"
    clusters = rows.groupBy("c75").agg(F.array_join(F.array_sort(F.collect_list(F.struct("n", F.expr(line).alias("l"))))["l"], "\n").alias("members"))
    return readers.clstr(spark, text(clusters, "concat('>Cluster ', c75)", "members"))


# ---------------------------------------------------------------- annotation

HITS = with_views("v_hits") + "x AS (SELECT 1) "


@query(HITS + "SELECT concat('gnl|c', contig_id) AS contig_id, CAST(start_pos AS INT) AS start_pos, CAST(end_pos AS INT) AS end_pos, concat('gnl|c', contig_id, CASE WHEN hit_id % 2 = 0 THEN '|provirus_3_9' ELSE '' END, '_', hit_id) AS gene, 'arg' AS annotation_amr FROM v_hits")
def read_virus(spark, sf_dir):
    """Predicted virus genes: the contig is in the gene's id, before what marks a provirus."""
    gene = F.expr("concat('gnl|c', contig_id, CASE WHEN hit_id % 2 = 0 THEN '|provirus_3_9' ELSE '' END, '_', hit_id)")
    return predicted(spark, sf_dir, gene, "virus")


def predicted(spark, sf_dir, gene: Column, kind: str) -> DataFrame:
    given = {"gene": gene, "start": F.col("start_pos"), "end": F.col("end_pos"), "annotation_amr": F.lit("arg")}
    path = scratch(spark)
    bind(spark, sf_dir, "v_hits").select(*[given.get(n, F.lit("NA")).cast("string").alias(n) for n in schemas.PREDICTED_GENES]).write.options(sep="\t", header=True).csv(path)
    return readers.annotation(spark, path, kind).select("contig_id", "start_pos", "end_pos", "gene", "annotation_amr")


@query(HITS + "SELECT concat('gnl|c', contig_id) AS contig_id, CAST(start_pos AS INT) AS start_pos, CAST(end_pos AS INT) AS end_pos, concat('gnl|c', contig_id, '_', hit_id) AS gene, 'arg' AS annotation_amr FROM v_hits")
def read_plasmid(spark, sf_dir):
    return predicted(spark, sf_dir, F.expr("concat('gnl|c', contig_id, '_', hit_id)"), "plasmid")


@query(HITS + "SELECT concat('c', contig_id) AS contig_id, CAST(start_pos AS INT) AS start_pos, CAST(end_pos AS INT) AS end_pos, CAST(hit_id AS VARCHAR) AS mge_no, 'IS' AS type FROM v_hits")
def read_mobile(spark, sf_dir):
    """Mobile elements: comment lines above the header, and a contig name with more words."""
    line = "concat_ws(',', hit_id, 'n', 's', 'p', 'IS', '1', '1', '0', '1', '1', '0', '0', concat('c', contig_id, ' len=9'), start_pos, end_pos, '9M')"
    head = "#date: x\n#sample: y\nmge_no,name,synonyms,prediction,type,allele_len,depth,e_value,identity,coverage,gaps,substitution,contig,start,stop,cigar"
    # The first row of each task, so of each file, stands below the head.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    path = scratch(spark)
    bind(spark, sf_dir, "v_hits").repartition(3).select(F.when(first, F.concat(F.lit(head + "\n"), F.expr(line))).otherwise(F.expr(line)).alias("value")).write.text(path)
    return readers.annotation(spark, path, "mobile").select("contig_id", "start_pos", "end_pos", "mge_no", "type")


@query(HITS + "SELECT concat('c', contig_id) AS contig_id, CAST(start_pos AS INT) AS start_pos, CAST(end_pos AS INT) AS end_pos, concat('g', hit_id) AS resistance_gene, 'ph' AS phenotype, 'acc' AS accession FROM v_hits")
def read_resistance(spark, sf_dir):
    """Resistance genes: positions as start..end."""
    names = ["Resistance gene", "Identity", "Alignment Length/Gene Length", "Coverage", "Position in reference", "Contig", "Position in contig", "Phenotype", "Accession no."]
    cells = [F.concat(F.lit("g"), "hit_id"), F.lit("99.0"), F.lit("10/10"), F.lit("100"), F.lit("1..10"), F.concat(F.lit("c"), "contig_id", F.lit(" length 9")), F.concat_ws("..", "start_pos", "end_pos"), F.lit("ph"), F.lit("acc")]
    path = scratch(spark)
    bind(spark, sf_dir, "v_hits").select(*[c.alias(n) for c, n in zip(cells, names, strict=True)]).write.options(sep="\t", header=True).csv(path)
    return readers.annotation(spark, path, "resistance")


@query(GENES + "SELECT gene_id AS query, concat('COG', gene_length % 7) AS COG_category, concat('does ', gene_length) AS Description, 'PF' AS PFAMs FROM v_genes")
def read_orthologs(spark, sf_dir):
    """Functional annotation: comments, a line of names, rows."""
    cells = {"query": "gene_id", "COG_category": "concat('COG', gene_length % 7)", "Description": "concat('does ', gene_length)", "PFAMs": "'PF'"}
    line = "concat_ws('\t', " + ", ".join(cells.get(c, "'-'") for c in schemas.ORTHOLOGS) + ")"
    path = with_head(text(bind(spark, sf_dir, "v_genes"), line), spark, "## comment\n#" + "\t".join(schemas.ORTHOLOGS) + "\n## more")
    return readers.orthologs(spark, path).select("query", "COG_category", "Description", "PFAMs")


# ---------------------------------------------------------------- plans and digests


@query("SELECT o_orderkey % 50 AS chunk_id, count(*) AS parts, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders GROUP BY 1")
def read_plan(spark, sf_dir):
    """A chunk plan as JSON: an object by chunk id, whose keys are numbers again when read."""
    rows = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 50).alias("k")).agg(F.array_sort(F.collect_list("o_custkey")).alias("contigs"))
    whole = rows.agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), "k", F.lit('": '), F.to_json("contigs"))), ", "), F.lit("}")).alias("value"))
    path = scratch(spark)
    whole.coalesce(1).write.text(path)
    parts = F.from_json("parts", "array<long>")
    return readers.chunk_plan(spark, path).select(F.col("chunk_id").cast("long").alias("chunk_id"), F.size(parts).cast("long").alias("parts"), F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("SELECT o_orderkey % 50 AS chunk_id, count(*) AS parts FROM orders GROUP BY 1")
def write_plan(spark, sf_dir):
    path = scratch(spark)
    writers.write_chunk_plan(table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("chunk_id"), F.col("o_custkey").alias("contig_id")), path)
    return spark.read.schema("chunk_id long, parts array<struct<contig_id:long>>").json(path).select("chunk_id", F.size("parts").cast("long").alias("parts"))


@query("SELECT concat('k=', r_regionkey) AS folder, CASE WHEN r_regionkey = 3 THEN 'other' ELSE md5(concat('region ', r_regionkey, chr(10))) END AS expected, md5(concat('region ', r_regionkey, chr(10))) AS found, r_regionkey <> 3 AS equal FROM region")
def file_digests(spark, sf_dir):
    """Digests of files, one a region, against a catalogue that is wrong in one."""
    path = scratch(spark)
    rows = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.concat(F.lit("region "), "r_regionkey").alias("value"))
    rows.write.partitionBy("k").text(path)
    folder = F.element_at(F.split("path", "/"), -2)
    files = spark.read.format("binaryFile").load(f"{path}/k=*/part-*").select(F.concat_ws("/", folder, F.element_at(F.split("path", "/"), -1)).alias("path"), folder.alias("folder"))
    says = rows.select(F.concat(F.lit("k="), "k").alias("folder"), F.when(F.col("k") == 3, "other").otherwise(F.md5(F.concat("value", F.lit("\n")))).alias("md5sum"))
    return readers.checked_digests(spark, files.join(says, "folder"), f"{path}/k=*/part-*").select(folder.alias("folder"), "expected", "found", "equal")
