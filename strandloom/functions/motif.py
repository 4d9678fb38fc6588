"""Restriction motifs: IUPAC codes, reverse complements, and where a motif is in a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The IUPAC nucleotide codes and their complements.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "R": "[AG]", "Y": "[CT]", "K": "[GT]", "M": "[AC]", "S": "[CG]", "W": "[AT]",
    "B": "[CGT]", "D": "[AGT]", "H": "[ACT]", "V": "[ACG]", "N": "[ACGT]",
}
COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A", "R": "Y", "Y": "R", "K": "M", "M": "K", "S": "S", "W": "W", "B": "V", "D": "H", "H": "D", "V": "B", "N": "N"}


def reverse_complement(motif: str) -> str:
    return "".join(COMPLEMENT[x] for x in reversed(motif.upper()))


def check_motif(motif: str) -> str:
    """The motif in upper case; an error if it has other letters or isn't its own reverse complement."""
    motif = motif.upper()
    if not motif or set(motif) - set(IUPAC):
        raise ValueError(f"motif {motif!r} is not made of IUPAC nucleotide codes")
    if reverse_complement(motif) != motif:
        raise ValueError(f"motif {motif} is not palindromic: its reverse complement is {reverse_complement(motif)}")
    return motif


def motif_regex(motif: str) -> str:
    return "".join(IUPAC[x] for x in motif.upper())


def reverse_complement_of(seq: Column) -> Column:
    """The reverse complement of a sequence column, IUPAC codes and lower case included."""
    codes = "".join(COMPLEMENT)
    to = "".join(COMPLEMENT.values())
    return F.reverse(F.translate(seq, codes + codes.lower(), to + to.lower()))


#: Running sums are built in slices of this many values: appending to an array copies it.
SLICE = 256


def _ends(pieces: Column, gap: int) -> Column:
    """The end of each piece but the last, where ``gap`` characters stand between pieces; time in proportion to their number."""
    done = F.array(F.struct(F.array().cast("array<bigint>").alias("ends"), F.lit(0).cast("bigint").alias("at")))

    def step(a: Column, p: Column) -> Column:
        end = a["at"] + F.length(p)
        return F.struct(F.concat(a["ends"], F.array(end)).alias("ends"), (end + gap).alias("at"))

    def add_slice(done: Column, own: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("ends"), F.element_at(done, -1)["at"].alias("at"))
        return F.concat(done, F.array(F.aggregate(own, start, step)))

    def all_ends(p: Column) -> Column:
        n = F.size(p) - 1
        own = F.transform(F.sequence(F.lit(0), F.floor(n / SLICE).cast("int")), lambda k: F.slice(p, k * SLICE + 1, F.least(n - k * SLICE, F.lit(SLICE))))
        return F.flatten(F.transform(F.aggregate(own, done, add_slice), lambda x: x["ends"]))

    # the array of one gives the pieces a name, so that they are worked out once
    return F.transform(F.array(pieces), lambda p: F.when(p.isNotNull(), all_ends(p)))[0]


def motif_starts(seq: Column, motif: str, overlap: bool = False, case_sensitive: bool = True) -> Column:
    """Array of the 0-based places where the motif starts, in order; one pass over the sequence.

    Without ``overlap`` a match begins after the one before ends. A read's own N matches no code.
    """
    flags, pattern = "" if case_sensitive else "(?i)", motif_regex(motif)
    if not overlap:
        return _ends(F.split(seq, flags + pattern, -1), len(motif))
    # a split at empty matches drops one at the start, so the sequence gets a character in front
    return F.transform(_ends(F.split(F.concat(F.lit("|"), seq), f"{flags}(?={pattern})", -1), 0), lambda x: x - 1)
