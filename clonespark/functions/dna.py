"""Nucleotide functions: complement, patterns, translation, cuts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC codes and their complements (blank, dot and gap stay), and codes to sets of bases.
IUPAC = "AGTCWSMKRYBVDHN"
COMPLEMENT = "TCAGWSKMYRVBHDN"
BASES_OF = {
    "A": "A", "G": "G", "T": "T", "C": "C", "U": "U", "W": "[AT]", "S": "[CG]", "M": "[AC]", "K": "[GT]", "R": "[AG]", "Y": "[CT]",
    "B": "[CGT]", "D": "[AGT]", "H": "[ACT]", "V": "[ACG]", "N": "[ACGT]",
}
#: The standard code: amino acids of the codons in the order of their bases, T C A G, the last base fastest.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
#: With gaps kept: three blanks or dots are a blank or a dot.
GAPPED = {**CODONS, "   ": " ", "...": "."}
#: In a strain that suppresses the stop TAG it is read as Q; no gaps.
SUPPRESSED = {**CODONS, "TAG": "Q"}


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str) -> Column:
    """IUPAC complement, read backwards. Characters that are no code stay as they are."""
    return F.reverse(F.translate(_col(seq), IUPAC, COMPLEMENT))


def iupac_pattern(seq: Column | str, forward: bool = True) -> Column:
    """A regular expression for a sequence of IUPAC codes, or for its reverse complement; other characters stay."""
    letters = F.split(F.upper(_col(seq)), "")
    if not forward:
        letters = F.split(reverse_complement(F.upper(_col(seq))), "")
    table = F.create_map(*(F.lit(x) for pair in BASES_OF.items() for x in pair))
    return F.array_join(F.transform(letters, lambda c: F.coalesce(F.try_element_at(table, c), c)), "")


def translate_dna(seq: Column | str, code: dict[str, str] | str | None = None) -> Column:
    """Amino acids of the codons from the first base on; X for unknown or partial codons; empty for an empty sequence.

    code: None for the standard code with gaps, any name for the code in which TAG is Q, or a map of codons. Lower-case codons are unknown.
    """
    codons = GAPPED if code is None else SUPPRESSED if isinstance(code, str) else code
    table = F.create_map(*(F.lit(x) for pair in sorted(codons.items()) for x in pair))
    s = _col(seq)
    acids = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1)), F.lit(3)), lambda i: F.coalesce(F.try_element_at(table, F.substring(s, i, F.lit(3))), F.lit("X")))
    return F.when(F.length(s) == 0, F.lit("")).otherwise(F.array_join(acids, ""))


def sequence_class(seq: Column | str) -> Column:
    """True for nucleotides, false for amino acids, null for neither. An empty string is nucleotides."""
    s = _col(seq)
    return F.when(s.rlike(r"^[AGTCagtc\-. ]*$"), F.lit(True)).when(s.rlike(r"^[ACDEFGHIKLMNPQRSTVWXYacdefghiklmnpqrstvwxy*\-. ]*$"), F.lit(False))


def variable_region(query: Column | str, query_start: Column | str, sbjct_start: Column | str) -> Column:
    """What stands before the aligned constant gene; a negative length counts from the end, as a slice would."""
    q, d = _col(query), _col(query_start) - _col(sbjct_start)
    return F.substring(q, F.lit(1), F.when(d >= 0, d).otherwise(F.greatest(F.length(q) + d, F.lit(0))))


def trim_to_frame(seq: Column | str, fr1_to: Column | str) -> Column:
    """From the first base on that is in frame with the end of framework 1."""
    return F.substring(_col(seq), (_col(fr1_to) % 3 + 1).cast("int"), F.lit(2147483647))


def anchored_cut(seq: Column | str, fr1_to: Column | str, keep: int = 60) -> Column:
    """From `keep` bases before the end of framework 1 on."""
    return F.substring(_col(seq), (_col(fr1_to) - (keep - 1)).cast("int"), F.lit(2147483647))


def region(seq: Column | str, start: Column | str, end: Column | str) -> Column:
    """Positions start to end, from 0, the end left out."""
    return F.substring(_col(seq), (_col(start) + 1).cast("int"), (_col(end) - _col(start)).cast("int"))


def fr4(seq: Column | str, fr4_from: Column | str, length: int = 33) -> Column:
    return F.substring(_col(seq), (_col(fr4_from) + 1).cast("int"), F.lit(length))


def frame(cdr3: Column | str) -> Column:
    """In or Out, by whether the length is a multiple of three."""
    return F.when(F.length(_col(cdr3)) % 3 == 0, F.lit("In")).otherwise(F.lit("Out"))


def has_stop(protein: Column | str) -> Column:
    return F.contains(_col(protein), F.lit("*"))


def cdr3_window(protein: Column | str, fr3_to: Column | str) -> Column:
    """The 28 residues from two after framework 3 on, in which a protein's CDR3 lies."""
    return F.substring(_col(protein), (_col(fr3_to) + 3).cast("int"), F.lit(28))


def tcr_protein(seq: Column | str) -> Column:
    """Translation from the second base on."""
    return translate_dna(F.substring(_col(seq), F.lit(2), F.lit(2147483647)))


def gene_family(gene: Column | str) -> Column:
    """A gene's name without its allele."""
    return F.substring_index(_col(gene), "*", 1)


def isotype_of(gene: Column | str) -> Column:
    """The isotype in a constant gene's name: IGHG1*01 is G1."""
    return F.substring(gene_family(gene), 4, 2147483647)


def umi_of(read: Column | str, reverse_end: Column | str, tail: int = 40) -> Column:
    """What follows the reverse primer, which ends at reverse_end within the read's last `tail` bases; all if it ends the read."""
    s, end = _col(read), _col(reverse_end)
    return F.when(end >= tail, s).otherwise(F.substring(s, (F.greatest(F.length(s), F.lit(tail)) - (tail - 1) + end).cast("int"), F.lit(2147483647)))


def insert_of(read: Column | str, forward_end: Column | str, reverse_start: Column | str, tail: int = 40) -> Column:
    """What lies between the primers of a read of `tail` bases or more."""
    s = _col(read)
    return F.substring(s, (_col(forward_end) + 1).cast("int"), F.greatest(F.length(s) - tail + _col(reverse_start) - _col(forward_end), F.lit(0)).cast("int"))


def vector_insert(vector: Column | str, motif: str, light: Column | str, linker: str, heavy: Column | str) -> Column:
    """The vector with light chain, linker and heavy chain in place of the first occurrence of the motif; null if it has none."""
    v = _col(vector)
    at = F.locate(motif, v)
    return F.when(at > 0, F.concat(F.substring(v, F.lit(1), at - 1), _col(light), F.lit(linker), _col(heavy), F.substring(v, at + len(motif), F.lit(2147483647))))
