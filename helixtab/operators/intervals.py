"""Interval overlap, interval-to-signal aggregation and per-base expansion."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtab.functions.codon import codon_number, codon_position
from helixtab.functions.sums import exact_sum, exact_total, exact_weighted_sum
from helixtab.operators.scan import distribution, running

# about the length of a coding segment: wider bins pair more strangers, narrower ones repeat more rows
BIN = 256
# widths up to 256 * 4 ** 12 bases, over 4 billion; longer intervals touch more bins of the last one
LEVELS = 12


def overlaps(
    df: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str], family: str | None = None
) -> DataFrame:
    """W-10: how each interval meets the earlier ones of its key, sorted by start.

    ``overlaps_previous`` compares with the interval right before (its end > start),
    ``touches_previous`` the same with >=, and ``overlaps_other_family`` wants another ``family`` as
    well.  Neighbours alone miss an interval that ends before a longer one does;
    ``overlaps_earlier`` compares with the largest end so far and finds those too.
    """
    scans = {"_prev_end": ("lag", F.col(end)), "_max_end": ("max", F.col(end))}
    if family:
        scans["_prev_family"] = ("lag", F.col(family))
    ranked = running(df, keys, [start, *tie], **scans)
    sure = lambda c: F.coalesce(c, F.lit(False))
    flags = {
        "overlaps_previous": sure(F.col("_prev_end") > F.col(start)),
        "touches_previous": sure(F.col("_prev_end") >= F.col(start)),
        "overlaps_earlier": sure(F.col("_max_end") > F.col(start)),
    }
    if family:
        flags["overlaps_other_family"] = flags["overlaps_previous"] & sure(
            F.col("_prev_family") != F.col(family)
        )
    return ranked.withColumns(flags).drop(*scans)


def _width(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(BIN).cast("bigint"), (2 * level).cast("int"))


def _level(start: Column, end: Column) -> Column:
    """The first level whose bins are at least as wide as the half-open interval, which so touches two of them at most."""
    length = end - start
    return sum((F.when(length > (BIN << (2 * k)), 1).otherwise(0) for k in range(LEVELS)), F.lit(0))


def _levels_of(df: DataFrame, level: Column) -> list[int]:
    """Levels that occur in a table; there are at most ``LEVELS + 1``."""
    return sorted(r[0] for r in df.select(level.alias("_l")).where("_l is not null").distinct().collect())


def _touched(start: Column, end: Column, own: Column, levels: Sequence[int]) -> Column:
    """One row for each bin that a half-open interval touches on its own level and on the wider ones of ``levels``;
    an empty interval touches none."""

    def on(k: int) -> Column:
        width = F.lit(BIN << (2 * k))
        bins = F.sequence(F.floor(start / width), F.floor((end - 1) / width))
        places = F.transform(bins, lambda b: F.struct(F.lit(k).alias("level"), b.alias("bin")))
        return F.when((end > start) & (own <= k), places).otherwise(F.array().cast("array<struct<level:int,bin:bigint>>"))

    places = [on(k) for k in levels]
    return F.explode(F.flatten(F.array(*places)))


def meeting(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str]
) -> DataFrame:
    """J-18, J-19: all pairs of half-open intervals of one key that share a base, once each.

    Bins come in several widths, each four times the one before.  An interval belongs to the one or two bins that it
    touches on the first level as wide as itself, and for the other side's sake to those on the wider levels that occur there.
    Two intervals meet on the wider one's level, in the bin where their common bases begin.  However
    long an interval is, it has no more than two rows a level, and where all are short there is one level only.
    """
    (ls, le), (rs, re) = left_span, right_span
    own_l, own_r = _level(F.col(ls), F.col(le)), _level(F.col(rs), F.col(re))
    levels = sorted({*_levels_of(left, own_l), *_levels_of(right, own_r)}) or [0]
    here = left.withColumn("_ll", own_l).withColumn("_at", _touched(F.col(ls), F.col(le), F.col("_ll"), levels))
    there = right.withColumn("_lr", own_r).withColumn("_at", _touched(F.col(rs), F.col(re), F.col("_lr"), levels))
    both = here.select("*", "_at.level", "_at.bin").drop("_at").join(there.select("*", "_at.level", "_at.bin").drop("_at"), [*keys, "level", "bin"])
    begin = F.greatest(F.col(ls), F.col(rs))
    return both.where(
        (F.col("level") == F.greatest("_ll", "_lr"))
        & (F.col("bin") == F.floor(begin / _width(F.col("level"))))
        & (begin < F.least(F.col(le), F.col(re)))
    ).drop("level", "bin", "_ll", "_lr")


def span_values(
    spans: DataFrame, signal: DataFrame, contig: str, start: str, end: str, value: str = "value"
) -> DataFrame:
    """J-18: the signal pieces inside each distinct span, as (contig, start, end, value, bases).

    Equal spans are joined once, and each pair of a span and a piece meets once.  Missing signal has no row.
    """
    s = spans.select(contig, start, end).distinct()
    t = signal.where(F.col(value).isNotNull()).select(
        F.col(contig), F.col("start0").alias("_s"), F.col("end").alias("_e"), F.col(value).alias("value")
    )
    bases = F.least(F.col(end), F.col("_e")) - F.greatest(F.col(start), F.col("_s"))
    return meeting(s, t, [contig], (start, end), ("_s", "_e")).select(contig, start, end, "value", bases.alias("bases"))


def segment_signal(
    segments: DataFrame, signal: DataFrame, contig: str = "chrom", start: str = "start0", end: str = "end"
) -> DataFrame:
    """A-36: mean value and covered bases per segment; nothing covered gives a null mean."""
    pieces = span_values(segments, signal, contig, start, end)
    total = exact_weighted_sum(F.col("value"), F.col("bases"))
    per_span = pieces.groupBy(contig, start, end).agg(
        total.alias("_total"), F.sum("bases").alias("_covered")
    )
    return (
        segments.join(per_span, [contig, start, end], "left")
        .withColumn("n_bases", F.col(end) - F.col(start))
        .withColumn("covered", F.coalesce(F.col("_covered"), F.lit(0)))
        .withColumn("signal_total", F.col("_total"))
        .withColumn("mean", F.col("_total") / F.col("_covered"))
        .drop("_total", "_covered")
    )


def transcript_signal(
    segments: DataFrame, signal: DataFrame, tx: str, cutoff: float, contig: str = "chrom",
    start: str = "start0", end: str = "end",
) -> DataFrame:
    """A-35: pooled mean, median, share of bases at or above a cutoff and coverage per transcript.

    Bases without a value are left out of mean, median and share, and count against coverage.
    """
    pieces = span_values(segments, signal, contig, start, end)
    valued = segments.join(pieces, [contig, start, end]).select(tx, "value", "bases")
    stats = distribution(
        valued, tx, "value", {"median": 0.5}, {"frac_conserved": cutoff}, weight="bases"
    ).withColumnRenamed("n", "covered_bases")
    sizes = segments.groupBy(tx).agg(F.sum(F.col(end) - F.col(start)).alias("cds_bases"))
    return (
        sizes.join(stats, tx, "left")
        .withColumn("covered_bases", F.coalesce("covered_bases", F.lit(0)))
        .withColumn("coverage", F.when(F.col("cds_bases") > 0, F.col("covered_bases") / F.col("cds_bases")))
    )


def _placed(segments: DataFrame, tx: str, order: Sequence[str], start_1based: str, end_1based: str) -> DataFrame:
    """Segments that have bases, with their length and the running length up to their end."""
    sized = segments.withColumn("_len", F.col(end_1based) - F.col(start_1based) + 1).where("_len > 0")
    return running(sized, tx, order, row_weight=100, _cum=("sum", F.col("_len")))


def per_base(
    segments: DataFrame, tx: str, order: Sequence[str], start_1based: str, end_1based: str, strand: str
) -> DataFrame:
    """W-11: one row per coding base with its place in the transcript, codon and codon position.

    The place is the running length of the earlier segments plus the offset inside the segment, so
    only segments are ordered, never bases; on the minus strand the offset runs backwards.
    """
    placed = _placed(segments, tx, order, start_1based, end_1based)
    bases = placed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_len") - 1)))
    forward = F.col(start_1based) + F.col("_k")
    backward = F.col(end_1based) - F.col("_k")
    pos = F.col("_cum") - F.col("_len") + F.col("_k") + 1
    return (
        bases.withColumn("genomic_pos", F.when(F.col(strand) == -1, backward).otherwise(forward))
        .withColumn("cds_pos", pos)
        .withColumn("codon_number", codon_number(F.col("cds_pos")))
        .withColumn("codon_position", codon_position(F.col("cds_pos")))
        .drop("_len", "_cum", "_k")
    )


def per_residue(bases: DataFrame, tx: str, value: str) -> DataFrame:
    """A-37: mean over a codon and over its positions 1 and 2; missing values are left out."""
    first_two = F.when(F.col("codon_position") < 3, F.col(value))
    return bases.groupBy(tx, "codon_number").agg(
        (exact_sum(F.col(value)) / F.count(value)).alias("codon_mean"),
        F.when(F.count(first_two) > 0, exact_sum(first_two) / F.count(first_two)).alias("pos12_mean"),
    )


def segment_residues(
    segments: DataFrame, tx: str, order: Sequence[str], start_1based: str, end_1based: str, strand: str,
    value: Callable[[Column, Column], Column],
) -> DataFrame:
    """A-37 from segments: the codons of ``per_residue`` over ``per_base``, without a row per base.

    ``value`` gives a base's value from its genomic place and codon position.  A codon inside one segment is finished
    in that segment's row; only those at a segment's edges, two at most, are grouped, and there each base has one row.
    """
    placed = _placed(segments, tx, order, start_1based, end_1based)
    before, upto = F.col("_cum") - F.col("_len"), F.col("_cum")

    def valued(codons: Column) -> DataFrame:
        rows = placed.withColumn("codon_number", F.explode(codons))
        cols = [F.col(tx), F.col("codon_number")]
        for i in (1, 2, 3):
            k = (F.col("codon_number") - 1) * 3 + (i - 1) - before
            place = F.when(F.col(strand) == -1, F.col(end_1based) - k).otherwise(F.col(start_1based) + k)
            here = (k >= 0) & (k < F.col("_len"))
            cols.append(F.when(here, value(place, F.lit(i))).cast("double").alias(f"_v{i}"))
            cols.append(here.alias(f"_h{i}"))
        return rows.select(*cols)

    first, last = F.ceil(before / 3).cast("bigint") + 1, F.floor(upto / 3).cast("bigint")
    whole = valued(F.when(first <= last, F.sequence(first, last)))
    edges = F.array_distinct(F.array(codon_number(before + 1), codon_number(upto)))
    split = valued(edges).where("not (_h1 and _h2 and _h3)")
    values = ["_v1", "_v2", "_v3"]
    split = split.groupBy(tx, "codon_number").agg(*[F.max(v).alias(v) for v in values])
    codons = whole.select(tx, "codon_number", *values).unionByName(split)

    def mean(cols: Sequence[str]) -> Column:
        n = sum(F.col(c).isNotNull().cast("int") for c in cols)
        return F.when(n > 0, exact_total(*[F.col(c) for c in cols]) / n)

    return codons.select(tx, "codon_number", mean(values).alias("codon_mean"), mean(values[:2]).alias("pos12_mean"))


def points_in_spans(points: DataFrame, spans: DataFrame, key: str, pos: str, start: str, end: str) -> DataFrame:
    """J-19: every (point, span) pair with start <= pos <= end inside one key."""
    p = points.withColumn("_p0", F.col(pos).cast("bigint")).withColumn("_p1", F.col("_p0") + 1)
    s = spans.withColumn("_s1", F.col(end).cast("bigint") + 1)
    return meeting(p, s, [key], ("_p0", "_p1"), (start, "_s1")).drop("_p0", "_p1", "_s1")


def boundaries(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """W-14: rows at which a value differs from the row before."""
    ranked = running(df, keys, order, _before=("lag", F.col(value)))
    return ranked.where(F.col("_before").isNotNull() & (F.col("_before") != F.col(value))).drop("_before")


def segment_boundaries(
    segments: DataFrame, tx: str, order: Sequence[str], start_1based: str, end_1based: str, value: str
) -> DataFrame:
    """W-14 from segments: the rows of ``boundaries`` over ``per_base`` for a value of the segment.

    Inside a segment it stays the same, so only the first base of one can differ from the base before.
    """
    sized = segments.withColumn("_len", F.col(end_1based) - F.col(start_1based) + 1).where("_len > 0")
    scans = {"_cum": ("sum", F.col("_len")), "_before": ("lag", F.col(value))}
    changed = running(sized, tx, order, **scans).where(F.col("_before").isNotNull() & (F.col("_before") != F.col(value)))
    return changed.withColumn("cds_pos", F.col("_cum") - F.col("_len") + 1).drop("_len", "_cum", "_before")
