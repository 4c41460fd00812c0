"""Plans of genome chunks. Spark deals work out by itself; these are for tools that want the plan."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import workers_import
from .ranks import ranked


def run_chunks(contigs: DataFrame, *, chunk_size: int) -> DataFrame:
    """Windows of each contig (contig_id, length): start, end (0-based, half open), pooled, counts_reads.

    Tails and contigs shorter than a chunk are pooled (see pack_contigs). A contig's reads are
    counted with its first window alone.
    """
    last = F.floor((F.col("length") - 1) / chunk_size)
    each = contigs.filter("length > 0").select("contig_id", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    start = F.col("k") * chunk_size
    return each.select("contig_id", start.alias("start"), F.least(start + chunk_size, "length").alias("end"), (start + chunk_size > F.col("length")).alias("pooled"), (F.col("k") == 0).alias("counts_reads"))


def merge_chunks(contigs: DataFrame, *, chunk_size: int) -> DataFrame:
    """Windows of each contig with the tail joined to the last full one."""
    n = F.greatest(F.floor(F.col("length") / chunk_size), F.lit(1))
    each = contigs.filter("length > 0").select("contig_id", "length", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("k"))
    return each.select("contig_id", (F.col("k") * chunk_size).alias("start"), F.when(F.col("k") == F.col("n") - 1, F.col("length")).otherwise((F.col("k") + 1) * chunk_size).alias("end"))


def packed_runs(lengths: list[int], counts: list[int], chunk_size: int) -> list[tuple[int, int, int, int, int, bool]]:
    """How chunks take pieces of which there are counts of each length (longest first).

    Each chunk begins with the longest piece left and is filled up with the shortest. Chunks that
    begin with one length and are filled up from another are alike but for the last ones, so they are
    counted, not made: length, first and last (of the pieces of a length, from the front or, where the flag
    says so, from the back, half open), the chunk that takes the first, and how many each chunk takes.
    """
    left, front, back = list(counts), [0] * len(counts), [0] * len(counts)
    out, high, low, chunk = [], 0, len(counts) - 1, 0

    def take(run: int, n: int, at: int, each: int, behind: bool) -> None:
        place = back if behind else front
        out.append((lengths[run], place[run], place[run] + n, at, each, behind))
        place[run] += n
        left[run] -= n

    while True:
        while high < len(left) and not left[high]:
            high += 1
        if high == len(left):
            return out
        room = chunk_size - lengths[high]
        while low > high and not left[low]:
            low -= 1
        each = room // lengths[low] if room >= 0 else 0
        if low == high:  # one length is left: the first of a chunk from the front, the others from the back
            n = left[high]
            chunks_ = -(-n // (each + 1))
            take(high, chunks_, chunk, 1, False)
            if n > chunks_:
                take(high, n - chunks_, chunk, each, True)
            return out
        # Chunks that this length fills up alone; then one that needs the next length as well.
        alike = left[high] if each == 0 else min(left[high], left[low] // each)
        if alike:
            take(high, alike, chunk, 1, False)
            if each:
                take(low, alike * each, chunk, each, True)
            chunk += alike
            continue
        take(high, 1, chunk, 1, False)
        k = low
        while room > 0 and k >= high:
            n = min(left[k], room // lengths[k])
            if n:
                take(k, n, chunk, n, True)
                room -= n * lengths[k]
            if left[k]:
                break
            k -= 1
        chunk += 1


#: Ranks that share a key when pieces meet the run they belong to.
RANKS = 256


def pack_contigs(pieces: DataFrame, *, chunk_size: int) -> DataFrame:
    """Short pieces (species_id, contig_id, length) in chunks of at most chunk_size: the longest left, filled up with the shortest.

    Adds chunk_id, from 0 in each species. Pieces of one length go by contig_id, from the front where they begin a chunk and from the back
    where they fill one up. What chunks take of each length follows from how many pieces have it: a species'
    histogram, of chunk_size rows at most, is all that one task sees of it.
    """
    pieces = pieces.select("species_id", "contig_id", F.col("length").cast("long").alias("length"))

    workers_import(pieces.sparkSession)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("length", ascending=False)
        found = packed_runs(rows["length"].tolist(), rows["n"].tolist(), chunk_size)
        return pd.DataFrame(found, columns=["length", "first", "last", "chunk", "each", "behind"]).assign(species_id=rows["species_id"].iloc[0])

    histogram = pieces.groupBy("species_id", "length").agg(F.count(F.lit(1)).alias("n"))
    runs = histogram.groupBy("species_id").applyInPandas(walk, "length long, first long, last long, chunk long, each long, behind boolean, species_id string")
    # From the front and from the back, a piece has two ranks; runs cover each piece in one of them.
    runs = runs.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first") / RANKS), F.floor((F.col("last") - 1) / RANKS))))
    places = ranked(pieces, ["species_id", "length"], ["contig_id"])
    both = F.explode(F.array(F.struct(F.lit(False).alias("behind"), F.col("rank").alias("place")), F.struct(F.lit(True).alias("behind"), (F.col("rank_of") - 1 - F.col("rank")).alias("place"))))
    each = places.select("species_id", "contig_id", "length", both.alias("side")).select("species_id", "contig_id", "length", "side.*", F.floor(F.col("side.place") / RANKS).alias("bucket"))
    taken = each.join(runs, ["species_id", "length", "behind", "bucket"]).filter((F.col("place") >= F.col("first")) & (F.col("place") < F.col("last")))
    return taken.select("species_id", "contig_id", "length", (F.col("chunk") + F.floor((F.col("place") - F.col("first")) / F.col("each"))).alias("chunk_id"))


def whole_plan(contigs: DataFrame, kind: str, *, chunk_size: int, order: str = "contig_id") -> DataFrame:
    """Every chunk of every species of contigs (species_id, contig_id, length, and the column of the order, if that is another): chunk_id, contig_id, start, end, counts_reads, pooled.

    Full windows come first, numbered by contig and place; what is shorter than a chunk is packed
    behind them. For run_snps a tail is packed too, and reads count with a contig's first window; for merge_snps a tail goes to the last full window.
    """
    if kind not in ("run_snps", "merge_snps"):
        raise ValueError(f"no plan of kind {kind}")
    keys = list(dict.fromkeys(["species_id", "contig_id", order]))
    n = F.floor(F.col("length") / chunk_size)
    last = n if kind == "run_snps" else F.greatest(n - 1, F.lit(0))
    each = contigs.filter("length > 0").select(*keys, "length", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("k")).filter(F.col("k") * chunk_size < F.col("length"))
    start = F.col("k") * chunk_size
    end = F.least(start + chunk_size, "length") if kind == "run_snps" else F.when(F.col("k") >= F.col("n") - 1, F.col("length")).otherwise(start + chunk_size)
    windows = each.select(*keys, start.alias("start"), end.alias("end"), (F.col("k") == 0).alias("counts_reads"))
    pooled = F.col("end") - F.col("start") < chunk_size
    full = ranked(windows.filter(~pooled), ["species_id"], list(dict.fromkeys([order, "start"])), "chunk_id")
    before = contigs.groupBy("species_id").agg(F.sum(n).cast("long").alias("full"))
    # A contig has one piece at most; it is packed by its place in the order.
    short = windows.filter(pooled).withColumn("piece", F.col(order))
    packed = pack_contigs(short.select("species_id", F.col("piece").alias("contig_id"), (F.col("end") - F.col("start")).alias("length")), chunk_size=chunk_size).select("species_id", F.col("contig_id").alias("piece"), "chunk_id")
    rest = short.join(packed, ["species_id", "piece"]).join(before, "species_id").withColumn("chunk_id", F.col("chunk_id") + F.col("full"))
    columns = ["species_id", "chunk_id", "contig_id", "start", "end", "counts_reads"]
    return full.select(*columns, F.lit(False).alias("pooled")).unionByName(rest.select(*columns, F.lit(True).alias("pooled")))


def contig_summary(contigs: DataFrame, *, chunk_size: int) -> DataFrame:
    """Per species: contigs, the longest one's length, and how many chunks run_chunks and its pooled rest begin with."""
    full = F.floor(F.col("length") / chunk_size)
    return contigs.groupBy("species_id").agg(F.count(F.lit(1)).alias("contigs"), F.max("length").alias("max_contig_length"), F.sum(full).alias("full_chunks"), F.count_if(F.col("length") % chunk_size > 0).alias("pooled_pieces"))


def slices(species: DataFrame, column: str = "species_id", *, size: int) -> DataFrame:
    """Adds slice, the number of a run of so many species in order of id."""
    return ranked(species, [], [column]).withColumn("slice", F.floor(F.col("rank") / size).cast("long")).drop("rank", "rank_of")


def adaptive_chunk_size(samples: Column, *, default: int) -> Column:
    """A chunk size for the number of samples: more samples, smaller chunks; 0 stands for whole species."""
    # Upper bounds of the number of samples, and the sizes.
    return F.when(samples <= 20, 0).when(samples <= 100, 2_000_000).when(samples <= 200, default).when(samples <= 500, 500_000).when(samples <= 800, 200_000).otherwise(100_000)
