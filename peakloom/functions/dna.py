"""DNA string expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def base_count(seq: Column, bases: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, bases, ""))


def cg_count(seq: Column) -> Column:
    """C and G bases."""
    return base_count(seq, "CG")


def gc_content(seq: Column, digits: int = 2) -> Column:
    """(G+C)/length, null for a sequence that is empty or has other letters than ACGT."""
    clean = (F.length(seq) > 0) & (base_count(seq, "ACGT") == F.length(seq))
    return F.when(clean, F.round(cg_count(seq) / F.length(seq), digits))


def clean_sequence(seq: Column) -> Column:
    """Upper case with unknown bases as ``-``."""
    return F.translate(F.upper(seq), "N", "-")
