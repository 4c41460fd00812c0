"""Nucleotide strings as expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# The amino acids of the genetic code (bacterial table), codons in the order T, C, A, G of each place; _ is stop.
CODE_ORDER = "TCAG"
CODE = "FFLLSSSSYY__CC_WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def complement(bases: Column) -> Column:
    """Upper-case A, C, G, T change; other characters stay."""
    return F.translate(bases, "ACGT", "TGCA")


def reverse_complement(bases: Column) -> Column:
    return F.reverse(complement(bases))


def subsequence(sequence: Column, start: Column, end: Column, strand: Column) -> Column:
    """Positions start to end (1-based, both included), on the strand given."""
    part = F.substring(sequence, start, end - start + 1)
    return F.when(strand == "-", reverse_complement(part)).otherwise(part)


def translate_codon(codon: Column) -> Column:
    """The amino acid letter; null unless all three bases are A, C, G or T."""
    place = [F.instr(F.lit(CODE_ORDER), F.substring(codon, i, 1)) - 1 for i in (1, 2, 3)]
    index = place[0] * 16 + place[1] * 4 + place[2] + 1
    return F.when(codon.rlike("^[ACGT]{3}$"), F.substring(F.lit(CODE), index, F.lit(1)))


def codon_table() -> dict[str, str]:
    return {"".join(c): a for c, a in zip(product(CODE_ORDER, repeat=3), CODE, strict=True)}


def degeneracy_table() -> list[tuple[str, int, str, str, str]]:
    """codon, place within (0 to 2), strand, site_type (1D to 4D) and amino_acids of A, C, G, T of the forward strand: 384 rows."""
    table = codon_table()
    rows = []
    for codon, within, (strand, bases) in product(table, range(3), (("+", "ACGT"), ("-", "TGCA"))):
        amino = [table[codon[:within] + b + codon[within + 1 :]] for b in bases]
        rows.append((codon, within, strand, f"{5 - len(set(amino))}D", ",".join(amino)))
    return rows


def renamed_prefixes(name: Column) -> Column:
    """Contig and genome ids without the annotator's prefix, and with short accession prefixes."""
    # The prefixes of the formats.
    return F.replace(F.replace(name, F.lit("gnl|Prokka|"), F.lit("")), F.lit("UHGGGC"), F.lit("GC"))


def sorted_map(entries: Column) -> Column:
    """A map with its entries in order of key."""
    return F.map_from_entries(F.array_sort(F.map_entries(entries)))


def reordered_map(entries: Column, keys: Column) -> Column:
    """A map of these keys, in their order; a key that is missing has null."""
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(entries, k)))


def hamming(a: Column, b: Column) -> Column:
    """Places that differ; a base other than A, C, G, T always does, and so does length."""
    left, right = F.split(a, ""), F.split(b, "")
    differs = lambda x, y: F.when((x == y) & x.isin("A", "C", "G", "T"), 0).otherwise(1)
    return F.aggregate(F.zip_with(left, right, lambda x, y: F.coalesce(differs(x, y), F.lit(1))), F.lit(0), lambda s, x: s + x)


def ambiguous(sequence: Column) -> Column:
    return sequence.rlike("[NXnx]")


def genome_of(gene: Column) -> Column:
    """The id up to its last underscore; all of it if there is none."""
    return F.regexp_replace(gene, "_[^_]*$", "")


def contig_name(genome: Column, number: Column, sequence: Column) -> Column:
    """genome, serial number, length in thousands and the end of the sequence's digest."""
    # format_number rounds the exact binary value half to even, as text of fixed decimals does elsewhere.
    length = F.call_function("format_number", F.length(sequence) / F.lit(1000), F.lit("0.0"))
    return F.concat(genome, F.lit("_C"), number.cast("string"), F.lit("_L"), length, F.lit("k_H"), F.right(F.md5(sequence), F.lit(6)))
