"""Equal-width bins with closed last edge, bin counts, and the stability index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.schemas import PSI_EPSILON


def doane_bins(n: Column, skew: Column) -> Column:
    """Doane's number of bins from the row count and the bias-corrected skewness."""
    spread = F.sqrt(6.0 * (n - 2) / ((n + 1.0) * (n + 3.0)))
    bins = F.bround(1 + F.log2(n) + F.log2(1 + F.abs(skew) / spread)).cast("int")
    return F.when(n < 3, 1).otherwise(F.greatest(F.lit(1), bins))


def corrected_skewness(n: Column, skew: Column) -> Column:
    """Sample skewness from population skewness; 0 for constant data."""
    return F.when(n > 2, F.coalesce(skew * F.sqrt(n * (n - 1.0)) / (n - 2), F.lit(0.0)))


def edge(i: Column, lo: Column, hi: Column, bins: Column) -> Column:
    """Edge ``i`` of ``bins`` equal-width bins; the last one is exactly ``hi``."""
    return F.when(i >= bins, hi).otherwise(i * ((hi - lo) / bins) + lo)


def edges(lo: Column, hi: Column, bins: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), bins), lambda i: edge(i, lo, hi, bins))


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: Column) -> Column:
    """Zero-based bin of ``x`` in [lo, hi], moved by one where the edges say so."""
    guess = F.least(F.floor((x - lo) * (bins / (hi - lo))).cast("int"), bins - 1)
    low = F.when(x < edge(guess, lo, hi, bins), 1).otherwise(0)
    high = F.when((guess < bins - 1) & (x >= edge(guess + 1, lo, hi, bins)), 1).otherwise(0)
    return guess - low + high


def edge_bin(x: Column, bin_edges: Column) -> Column:
    """Zero-based bin of ``x`` among sorted edges; null outside them.

    The equal-width place is tried first, as that is what profiles hold. Only where
    the edges disagree (uneven edges) are they counted through.
    """
    bins = F.size(bin_edges) - 1
    lo, hi = F.element_at(bin_edges, 1), F.element_at(bin_edges, -1)
    guess = F.greatest(F.lit(0), F.least(F.floor((x - lo) * (bins / (hi - lo))).cast("int"), bins - 1))
    fits = (x >= F.get(bin_edges, guess)) & (
        (x < F.get(bin_edges, guess + 1)) | (guess == bins - 1)
    )
    counted = F.least(F.size(F.filter(bin_edges, lambda e: e <= x)) - 1, bins - 1)
    return F.when((x >= lo) & (x <= hi), F.when(fits, guess).otherwise(counted))


def dense_counts(pairs: Column, bins: Column) -> Column:
    """Counts per bin from an array of (bin, n) structs, 0 where a bin is absent."""
    counts = F.map_from_entries(pairs)
    return F.transform(
        F.sequence(F.lit(0), bins - 1),
        lambda i: F.coalesce(F.try_element_at(counts, i), F.lit(0).cast("long")),
    )


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda acc, n: acc + n)


def stability_index(reference: Column, live: Column) -> Column:
    """Population stability index of two count arrays over the same bins."""
    p_total, q_total = total(reference), total(live)

    def term(p_count: Column, q_count: Column) -> Column:
        p = p_count / p_total + PSI_EPSILON
        q = q_count / q_total + PSI_EPSILON
        return (q - p) * F.log(q / p)

    terms = F.zip_with(reference, live, term)
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
