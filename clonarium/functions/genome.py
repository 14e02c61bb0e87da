"""Chromosomes, segments, copy numbers and loci."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chromosomes of the primary assembly as the gene files spell them.
PRIMARY_ASSEMBLY = [f"chr{c}" for c in [*range(1, 23), "X", "Y", "M"]]

# Bounds of the pathogenicity score classes.
BENIGN_BELOW = 0.34
PATHOGENIC_ABOVE = 0.564


def canonical_chromosome(col: Column) -> Column:
    """``chr17`` to ``17`` and ``M`` to ``MT``, always text."""
    bare = F.regexp_replace(col.cast("string"), "^chr", "")
    return F.when(bare == "M", "MT").otherwise(bare)


def on_primary_assembly(chromosome: Column) -> Column:
    return chromosome.isin(PRIMARY_ASSEMBLY)


def parse_segment(segment: Column) -> Column:
    """Struct (chr, start, end) from ``chr_start_end``.

    Further parts are dropped, missing parts are null, a non-number fails.
    """
    parts = F.split(segment, "_")
    return F.struct(
        canonical_chromosome(F.get(parts, F.lit(0))).alias("chr"),
        F.get(parts, F.lit(1)).cast("bigint").alias("start"),
        F.get(parts, F.lit(2)).cast("bigint").alias("end"),
    )


def major_minor(a: Column, b: Column) -> tuple[Column, Column]:
    """Larger and smaller allele copy number; a null allele is ignored."""
    return F.greatest(a, b), F.least(a, b)


def copy_number_summary(a: Column, b: Column) -> dict[str, Column]:
    """The five columns derived from the two allele copy numbers."""
    major, minor = major_minor(a, b)
    total = a + b
    return {
        "total_cn": total,
        "minor_cn": minor,
        "major_cn": major,
        "is_homdel": (a == 0) & (b == 0),
        "is_loh": (minor == 0) & (total > 0),
    }


def allele_fraction(var_count: Column, coverage: Column) -> Column:
    """Reads with the variant over all reads; null without coverage."""
    return F.try_divide(var_count, coverage)


def rebuilt_mutation_id(
    mutation_id: Column, chromosome: Column, pos: Column, ref: Column, alt: Column
) -> Column:
    """The id with its locus replaced; null when the locus was not mapped."""
    return F.concat(
        F.split_part(mutation_id, F.lit(":"), F.lit(1)),
        F.lit(":"),
        chromosome,
        F.lit(":"),
        pos.cast("string"),
        F.lit(":"),
        ref,
        F.lit(":"),
        alt,
    )


def score_class(score: Column) -> Column:
    """benign, ambiguous (both bounds included) or pathogenic."""
    known = F.nanvl(score, F.lit(None).cast("double"))
    return (
        F.when(known < BENIGN_BELOW, "benign")
        .when(known <= PATHOGENIC_ABOVE, "ambiguous")
        .when(known > PATHOGENIC_ABOVE, "pathogenic")
    )
