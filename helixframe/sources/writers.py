"""Writers of the tables and sequences that the workflows hand on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lz4 import write_lz4


def formatted(df: DataFrame, decimals: int = 3) -> DataFrame:
    """Doubles as text of fixed decimals, null as the text None; other columns as they are.

    Rounding is that of the exact binary value, half to even; only values below one unit of the
    last place may differ in it.
    """
    def cell(name: str, kind: str):
        text = F.call_function("format_number", F.col(name).cast("double"), F.lit("0." + "0" * decimals)) if kind in ("double", "float") else F.col(name).cast("string")
        return F.when(F.col(name).isNull(), "None").otherwise(text).alias(name)

    return df.select(*[cell(*c) for c in df.dtypes])


def write_tsv(df: DataFrame, path: str, *, decimals: int = 3, mode: str = "errorifexists", compression: str = "none", single: bool = False) -> None:
    """Typed rows as tab-separated text; single asks for one file, which one task then writes. Compression lz4 writes LZ4 frames, files of their own."""
    out = formatted(df, decimals)
    if compression == "lz4":
        lines = (out.coalesce(1) if single else out).select(F.to_csv(F.struct(*out.columns), {"sep": "\t"}).alias("value"))
        write_lz4(lines, path, head="\t".join(out.columns), mode=mode)
        return
    (out.coalesce(1) if single else out).write.mode(mode).options(sep="\t", header=True, compression=compression).csv(path)


def write_gene_info(genes: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Gene info in order of gene over all its files: a range shuffle, no single task."""
    write_tsv(genes.orderBy("gene_id"), path, mode=mode)


def headed(lines: DataFrame, head: str) -> DataFrame:
    """Lines (value) with a head above the first of each task, so of each file that they are written to."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return lines.select(F.when(first, F.concat(F.lit(head + "\n"), "value")).otherwise(F.col("value")).alias("value"))


def write_matrix(rows: DataFrame, path: str, numbers: DataFrame, *, decimals: int = 3, mode: str = "errorifexists", compression: str = "none") -> None:
    """A table with a column a sample, from rows whose last column is an array in the order of the samples' numbers (see snv.sample_arrays).

    numbers: sample_name, number. The names make the head; they alone are gathered, a name a sample.
    """
    *keys, values = rows.columns
    names = [r.sample_name for r in numbers.select("sample_name", "number").orderBy("number").toLocalIterator()]
    whole = dict(rows.dtypes)[values] in ("array<int>", "array<bigint>")
    cell = (lambda x: x.cast("string")) if whole else (lambda x: F.call_function("format_number", x.cast("double"), F.lit("0." + "0" * decimals)))
    lines = rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in keys], F.array_join(F.transform(values, cell), "\t")).alias("value"))
    head = "\t".join([*keys, *names])
    if compression == "lz4":
        write_lz4(lines, path, head=head, mode=mode)
    else:
        headed(lines, head).write.mode(mode).option("compression", compression).text(path)


#: What sites are dealt by when they are written for merging: any grouping of whole sites is then within a bucket.
SITE_BUCKET = ("ref_id", "ref_pos")


def write_sites(sites: DataFrame, table: str, path: str, *, buckets: int, mode: str = "errorifexists") -> None:
    """Sites of samples as a bucketed table, sorted within its buckets.

    Samples that are merged from such tables again and again are brought together by site once, here, and never shuffled afterwards. New samples
    are added with mode append and the same number of buckets.
    """
    dealt = sites.repartition(buckets, *SITE_BUCKET)
    dealt.write.mode(mode).option("path", path).bucketBy(buckets, *SITE_BUCKET).sortBy(*SITE_BUCKET).saveAsTable(table)


def write_fasta(df: DataFrame, path: str, *, id_column: str = "id", seq_column: str = "seq", mode: str = "errorifexists") -> None:
    df.select(F.concat(F.lit(">"), F.col(id_column), F.lit("\n"), F.col(seq_column)).alias("value")).write.mode(mode).text(path)


def write_chunk_plan(chunks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """chunk_id and parts as JSON lines."""
    chunks.groupBy("chunk_id").agg(F.collect_list(F.struct(*[c for c in chunks.columns if c != "chunk_id"])).alias("parts")).write.mode(mode).json(path)


def write_partitioned(df: DataFrame, path: str, *keys: str, mode: str = "errorifexists") -> None:
    """Parquet, a folder a key, so that later reads skip what they don't need; rows of a key are brought together first."""
    df.repartition(*keys).write.mode(mode).partitionBy(*keys).parquet(path)
