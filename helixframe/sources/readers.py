"""Readers of tables, sequences, features, hits and annotations. Paths may be globs or lists; Spark reads .gz and .bz2 by name, .lz4 frames are read here."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import parts, schemas
from .fastq import records as multiline_records
from .head import head_lines
from .lz4 import read_lz4
from .scratch import kept
from .session import workers_import

Paths = str | Sequence[str]


def tsv(spark: SparkSession, path: Paths, schema: str | None, *, header: bool = True, columns: Sequence[str] | None = None, comment: str | None = None) -> DataFrame:
    """A tab-separated table of a declared schema; a header that differs, or a value of another type, is an error.

    Without a schema, types are inferred, which reads the files once more. Files that end in .lz4 are LZ4 frames.
    """
    if framed(path):
        return _tsv_lz4(spark, path, schema, header=header, columns=columns, comment=comment)
    options = {"sep": "\t", "header": header, "mode": "FAILFAST", "enforceSchema": not header, "nullValue": "", "emptyValue": ""}
    reader = spark.read.options(**options)
    reader = reader.schema(schema) if schema else reader.options(inferSchema=True, enforceSchema=True)
    if comment:
        reader = reader.option("comment", comment)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df.select(*columns) if columns else df


def framed(path: Paths) -> bool:
    files = [path] if isinstance(path, str) else list(path)
    ends = {p.rstrip("/*").endswith(".lz4") for p in files}
    if len(ends) > 1:
        raise ValueError("LZ4 frames are read apart from other files")
    return ends == {True}


def _tsv_lz4(spark: SparkSession, path: Paths, schema: str | None, *, header: bool = True, columns: Sequence[str] | None = None, comment: str | None = None, file: str | None = None) -> DataFrame:
    """The rows of LZ4 frames; file names a column for the path of the file that a row is from."""
    if schema is None:
        raise ValueError("types of LZ4 frames are not inferred")
    rows = read_lz4(spark, path)
    names = spark.createDataFrame([], schema).columns
    if header:
        # In the same pass: the first line of a file is dropped, or an error if it has other names.
        differs = F.raise_error(F.concat(F.lit("header differs: "), "value")).cast("boolean")
        rows = rows.filter(F.when(F.col("first"), F.when(F.col("value") == "\t".join(names), False).otherwise(differs)).otherwise(True))
    if comment:
        rows = rows.filter(~F.col("value").startswith(comment))
    # null values as in the reader of plain files; an empty line is no row there either.
    cells = F.from_csv("value", schema, {"sep": "\t", "mode": "FAILFAST", "nullValue": "", "emptyValue": ""})
    df = rows.filter("value <> ''").select(cells.alias("row"), *([F.col("path").alias(file)] if file else [])).select("row.*", *([file] if file else []))
    return df.select(*columns) if columns else df


def lines(spark: SparkSession, path: Paths) -> DataFrame:
    if framed(path):
        return read_lz4(spark, path).select("value")
    return spark.read.text(path if isinstance(path, str) else list(path))


def m8(spark: SparkSession, path: Paths) -> DataFrame:
    """Hits with the read length that the query's name ends in."""
    return tsv(spark, path, schemas.M8, header=False).withColumn("qlen", F.element_at(F.split("query", "_"), -1).cast("int"))


def fastx(spark: SparkSession, path: Paths, *, multiline: bool = False, max_reads: int | None = None) -> DataFrame:
    """id, seq, qual, length of FASTA and FASTQ records; the file's ending tells which.

    FASTA records may span lines. A FASTQ record has four lines, which are numbered within their
    file from what each split holds, so that splits are read in parallel and none is held whole.
    With multiline its sequence and qualities may span lines too; see fastq for how splits are read in parallel then.
    max_reads is how many records of four lines are wanted of each FASTQ file; see head for what is read of it then.
    """
    if max_reads is not None and multiline:
        raise ValueError("a limit goes by records of four lines")
    files = [path] if isinstance(path, str) else list(path)
    fasta = [p for p in files if not any(p.rstrip("/*").removesuffix(".gz").removesuffix(".bz2").endswith(e) for e in (".fastq", ".fq"))]
    fastq = [p for p in files if p not in fasta]
    found = []
    if fasta:
        body = F.split(F.regexp_replace("value", "^>", ""), "\n", 2)
        records = spark.read.option("lineSep", "\n>").text(fasta).filter(F.length(F.trim("value")) > 0).select(body.alias("b"))
        found.append(records.select(F.split(F.get("b", F.lit(0)), r"\s+")[0].alias("id"), F.regexp_replace(F.coalesce(F.get("b", F.lit(1)), F.lit("")), r"\s", "").alias("seq"), F.lit(None).cast("string").alias("qual")))
    if fastq:
        found.append(multiline_records(spark.read.text(fastq), kept) if multiline else fastq_records(numbered_lines(spark, fastq) if max_reads is None else head_lines(spark, fastq, 4 * max_reads)))
    df = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return df.withColumn("length", F.length("seq"))


def fastq_records(lines_: DataFrame) -> DataFrame:
    """id, seq, qual of records of four lines (path, line_no from 0, value); an empty read is a record too, an incomplete one at the end is none."""
    at = lambda k: F.max(F.when(F.col("line_no") % 4 == k, F.col("value")))
    records = lines_.groupBy("path", F.floor(F.col("line_no") / 4).alias("record")).agg(at(0).alias("head"), at(1).alias("seq"), at(3).alias("qual"))
    return records.filter(F.col("head").startswith("@") & F.col("qual").isNotNull()).select(F.regexp_extract("head", r"^@(\S*)", 1).alias("id"), "seq", "qual")


def read_names(records: DataFrame) -> DataFrame:
    """Adds query: the id and the length of the read."""
    return records.withColumn("query", F.concat_ws("_", "id", "length"))


def gff_features(spark: SparkSession, path: Paths) -> DataFrame:
    """Gene features of GFF3: rows with an ID whose source is not the annotator itself; the ID is the locus tag."""
    rows = lines(spark, path).filter(~F.col("value").startswith("#") & F.col("value").contains("\t")).select(F.split("value", "\t").alias("f")).filter(F.size("f") == 9)
    attribute = lambda name: F.regexp_extract(F.col("f")[8], rf"(?:^|;){name}=([^;]+)", 1)
    features = rows.select(attribute("ID").alias("gene_id"), F.col("f")[0].alias("contig_id"), F.col("f")[3].cast("int").alias("start"), F.col("f")[4].cast("int").alias("end"), F.col("f")[6].alias("strand"), F.col("f")[2].alias("gene_type"), F.col("f")[1].alias("source"))
    return features.filter((F.col("gene_id") != "") & (F.col("source") != "prokka")).drop("source")


def hmm_hits(spark: SparkSession, path: Paths) -> DataFrame:
    """gene_id, marker_id, evalue, qcov, tcov of a domain table of an HMM search."""
    f = lambda i: F.get("f", F.lit(i))
    rows = lines(spark, path).filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split(F.trim("value"), r"\s+").alias("f"))
    share = lambda a, b, n: (f(b).cast("int") - f(a).cast("int") + 1) / f(n).cast("int")
    return rows.select(f(0).alias("gene_id"), f(3).alias("marker_id"), f(12).cast("double").alias("evalue"), share(19, 20, 2).alias("qcov"), share(15, 16, 5).alias("tcov"))


def uclust(spark: SparkSession, path: Paths) -> DataFrame:
    return tsv(spark, path, schemas.UCLUST, header=False)


def clstr(spark: SparkSession, path: str) -> DataFrame:
    """cluster, member_no, length, gene_id, is_representative of a cluster listing; a cluster's text is one record."""
    records = spark.read.option("lineSep", ">Cluster ").text(path).filter(F.trim("value") != "")
    each = records.select(F.trim(F.split("value", "\n")[0]).cast("int").alias("cluster"), F.explode(F.filter(F.slice(F.split("value", "\n"), 2, 1 << 30), lambda x: F.trim(x) != "")).alias("m"))
    part = lambda p: F.regexp_extract("m", p, 1)
    return each.select("cluster", part(r"^(\d+)").cast("int").alias("member_no"), part(r"\s(\d+)(?:nt|aa),").cast("int").alias("length"), part(r">(.+?)\.\.\.").alias("gene_id"), F.col("m").endswith("*").alias("is_representative"))


def genomes(spark: SparkSession, path: Paths) -> DataFrame:
    return tsv(spark, path, schemas.GENOMES)


def samples(spark: SparkSession, manifest: Paths, file: str, schema: str) -> DataFrame:
    """The tables of all samples of a manifest in one scan, each row with its sample_name."""
    # The manifest's columns go by position: the name of the second varies.
    listed = spark.read.options(sep="\t", header=True, enforceSchema=True).schema(schemas.SAMPLES).csv(manifest if isinstance(manifest, str) else list(manifest))
    paths = [f"{r.outdir}/{r.sample_name}/{file}" for r in listed.toLocalIterator()]  # one short line a sample
    name = lambda path: F.regexp_extract(path, r"([^/]+)/" + file.replace(".", r"\.") + "(?:/[^/]*)?$", 1)
    if framed(paths):
        return _tsv_lz4(spark, paths, schema, file="_file").withColumn("sample_name", name(F.col("_file"))).drop("_file")
    return tsv(spark, paths, schema).withColumn("sample_name", name(F.input_file_name()))


def contig_of_gene(gene: Column, provirus: bool = False) -> Column:
    """The contig a predicted gene's id starts with; what marks a provirus within it is cut too."""
    contig = F.regexp_replace(gene, "_[^_]*$", "")
    return F.regexp_replace(contig, r"\|p.*$", "") if provirus else contig


def annotation(spark: SparkSession, path: Paths, kind: str) -> DataFrame:
    """contig_id, start_pos, end_pos and what else counts, of one kind of annotation file: virus, plasmid, mobile or resistance."""
    text = {"sep": "\t", "header": True, "mode": "FAILFAST"}
    paths = path if isinstance(path, str) else list(path)
    if kind in ("virus", "plasmid"):
        df = spark.read.options(**text).csv(paths)
        found = df.select(contig_of_gene(F.col("gene"), kind == "virus").alias("contig_id"), F.col("start").cast("int").alias("start_pos"), F.col("end").cast("int").alias("end_pos"), "gene", "strand", "gene", "annotation_conjscan", "annotation_amr", "annotation_accessions", "annotation_description")
        return found.toDF(*["contig_id", "start_pos", "end_pos", "gene", "strand", "gene_2", *found.columns[6:]]).drop("gene_2")
    if kind == "mobile":
        df = spark.read.options(header=True, comment="#").csv(paths)
        end = F.col("end") if "end" in df.columns else F.col("stop")  # both names occur
        return df.select(F.split("contig", " ")[0].alias("contig_id"), F.col("start").cast("int").alias("start_pos"), end.cast("int").alias("end_pos"), "mge_no", "name", "prediction", "type")
    if kind == "resistance":
        df = spark.read.options(**text).csv(paths).toDF("resistance_gene", "identity", "lengths", "coverage", "ref_position", "contig", "position", "phenotype", "accession")
        at = F.split("position", r"\.\.")
        return df.select(F.split("contig", " ")[0].alias("contig_id"), at[0].cast("int").alias("start_pos"), at[1].cast("int").alias("end_pos"), "resistance_gene", "phenotype", "accession")
    raise ValueError(f"no annotation of kind {kind}")


def orthologs(spark: SparkSession, path: Paths) -> DataFrame:
    """Functional annotation: lines that begin with ## are comments, the one with a single # has the names.

    All files must have the same names; where none has any (empty files), they are the format's own.
    """
    rows = lines(spark, path).filter(~F.col("value").startswith("##"))
    # One line of names is enough to go by, and the reader stops there; other files are held against it as they are read.
    head = rows.filter(F.col("value").startswith("#")).first()
    names = head.value.lstrip("#").split("\t") if head else list(schemas.ORTHOLOGS)
    cells = F.split("value", "\t")
    differs = F.raise_error(F.lit("files of functional annotation differ in their columns")).cast("boolean")
    body = rows.filter(F.when(~F.col("value").startswith("#"), True).when(F.ltrim("value", F.lit("#")) == "\t".join(names), False).otherwise(differs))
    return body.select(*[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(names)])


def id_list(spark: SparkSession, ids: str) -> DataFrame:
    """species_id of a list: ids with commas between, or a file with one a line."""
    if "," in ids or "/" not in ids:
        return spark.createDataFrame([(i.strip(),) for i in ids.split(",") if i.strip()], "species_id string").distinct()
    return lines(spark, ids).select(F.trim(F.split("value", "\t")[0]).alias("species_id")).filter("species_id <> ''").distinct()


def chunk_plan(spark: SparkSession, path: str) -> DataFrame:
    """chunk_id and its parts of a JSON chunk plan."""
    plan = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m")).select(F.explode("m"))
    return plan.select(F.col("key").cast("int").alias("chunk_id"), F.col("value").alias("parts"))


#: Bytes of a file that a task holds while it digests it.
DIGEST_BYTES = 4 << 20


def digests(spark: SparkSession, path: Paths) -> DataFrame:
    """path, size and md5sum of files; each is read as a stream, so none is too large."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, inner = parts.open_path(path)
                sum_ = hashlib.md5(usedforsecurity=False)
                with fs.open_input_stream(inner, compression=None) as stream:
                    while block := stream.read(DIGEST_BYTES):
                        sum_.update(block)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([sum_.hexdigest()])], ["path", "size", "md5sum"])

    workers_import(spark)
    files = spark.createDataFrame(parts.globbed(spark, [path] if isinstance(path, str) else list(path)), "path string, size long")
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(digest, "path string, size long, md5sum string")


def checked_digests(spark: SparkSession, catalogue: DataFrame, path: Paths) -> DataFrame:
    """path, expected, found, equal of the files of a path and of a catalogue (path, md5sum): what only one of them has is not equal.

    Paths are compared by their last parts: a catalogue says where a file lies below some folder.
    """
    found = digests(spark, path).select(F.col("path").alias("full"), F.col("md5sum").alias("found"), F.element_at(F.split("path", "/"), -1).alias("name"))
    listed = catalogue.select("path", F.col("md5sum").alias("expected"), F.element_at(F.split("path", "/"), -1).alias("name"))
    ends = F.expr("full = path OR endswith(full, concat('/', ltrim('/', path)))")
    both = listed.alias("l").join(found.alias("f"), (F.col("l.name") == F.col("f.name")) & ends, "full_outer")
    return both.select(F.coalesce("path", "full").alias("path"), "expected", "found", F.coalesce(F.col("expected") == F.col("found"), F.lit(False)).alias("equal"))


def numbered_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """path, line_no (from 0, in the file's own order) and value of text files.

    Spark deals splits out by size, so ids that rise within a task say nothing across splits. Each
    split's first id and number of lines are counted first (a row a split); a line's number is its
    place in the split behind all lines of the splits before it.
    """
    read = spark.read.text(path if isinstance(path, str) else list(path))
    rows = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), "value")
    splits = rows.groupBy("path", "split").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(offsets, ["path", "split"]).select("path", (F.col("id") + F.col("shift")).alias("line_no"), "value")
