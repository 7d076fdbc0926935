"""Coordinate liftover as an equi join on (chromosome, bin) plus a range.

The block table is first cut at bin borders and made disjoint, keeping the best
score where chains overlap. A position then meets at most one piece, so rows pass
two left joins and are never grouped; a hot position needs no regrouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import vocab
from .lookup import checked_broadcast

BIN_BITS = 14
# A piece takes about 150 bytes of a broadcast table, which the driver builds; chains
# between two assemblies of a genome give some two hundred thousand pieces.
BROADCAST_PIECES = 300_000


def best_pieces(blocks: DataFrame, bin_bits: int = BIN_BITS) -> DataFrame:
    """Disjoint best-scoring pieces: (t_chrom, bin, p_start, p_end, q_chrom, origin, step).

    ``origin + step * pos`` is the lifted 0-based position. Ties in score go to the
    smaller chain id.

    Blocks are stored in power-of-two nodes, at most two per level, and every piece
    asks the nodes above it for the best block. Work grows with blocks times levels
    even where very many blocks overlap.
    """
    bins = F.sequence(F.shiftright("t_start", bin_bits), F.shiftright(F.col("t_end") - 1, bin_bits))
    bin_start = F.shiftleft("bin", bin_bits)
    forward = F.col("strand") == "+"
    ahead = F.col("q_start") - F.col("t_start")
    hit = F.struct(
        F.col("score").alias("score"),
        (-F.col("chain_id")).alias("rank"),
        F.col("q_chrom").alias("q_chrom"),
        F.when(forward, ahead).otherwise(
            F.col("q_size") - 1 - F.col("q_start") + F.col("t_start")).alias("origin"),
        F.when(forward, 1).otherwise(-1).cast("bigint").alias("step"),
    )
    cut = (
        blocks.where(F.col("t_end") > F.col("t_start"))
        .select("t_chrom", "t_start", "t_end", hit.alias("hit"), F.explode(bins).alias("bin"))
        .select(
            "t_chrom", "bin", "hit",
            F.greatest("t_start", bin_start).alias("c_start"),
            F.least("t_end", bin_start + (1 << bin_bits)).alias("c_end"),
        )
    )
    # Between neighbouring borders of a bin the set of covering blocks is constant.
    # A bin has no more distinct borders than positions.
    borders = cut.select("t_chrom", "bin", F.explode(F.array("c_start", "c_end")).alias("p_start")).distinct()
    in_bin = Window.partitionBy("t_chrom", "bin").orderBy("p_start")
    pieces = borders.withColumn("p_end", F.lead("p_start").over(in_bin)).where(F.col("p_end").isNotNull())

    levels = F.explode(F.sequence(F.lit(0), F.lit(bin_bits))).alias("level")
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
    first = F.call_function("shiftright", F.col("c_start") + size - 1, F.col("level"))
    last = F.call_function("shiftright", F.col("c_end"), F.col("level")) - 1
    parent = F.shiftright("node", 1)
    node_inside = (F.col("node") * size >= F.col("c_start")) & ((F.col("node") + 1) * size <= F.col("c_end"))
    parent_inside = (
        (F.col("level") < bin_bits) & (parent * 2 * size >= F.col("c_start"))
        & ((parent + 1) * 2 * size <= F.col("c_end"))
    )
    nodes = (
        cut.select("t_chrom", "c_start", "c_end", "hit", levels)
        .withColumn("node", F.explode(F.array_distinct(F.array(first, last))))
        .where(node_inside & ~parent_inside)
        .groupBy("t_chrom", "level", "node").agg(F.max("hit").alias("hit"))
    )
    asked = pieces.select("t_chrom", "bin", "p_start", "p_end", levels).withColumn(
        "node", F.call_function("shiftright", F.col("p_start"), F.col("level")))
    # A block has many nodes, which the engine's estimate does not count: never broadcast them.
    return (
        asked.join(nodes.hint("merge"), ["t_chrom", "level", "node"])
        .groupBy("t_chrom", "bin", "p_start", "p_end").agg(F.max("hit").alias("hit"))
        .select("t_chrom", "bin", "p_start", "p_end", "hit.q_chrom", "hit.origin", "hit.step")
    )


def with_prefix(chrom: Column) -> Column:
    """Chain files name chromosomes with a prefix."""
    return F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def lift_position(df: DataFrame, pieces: DataFrame, chrom: str, position: str, to_chrom: str,
                  to_position: str, bin_bits: int = BIN_BITS, prefixed: bool = True,
                  to_step: str | None = None) -> DataFrame:
    """Lift a 1-based position; unmapped gives nulls (H28, H29). ``to_step`` names a column for
    the direction of the chain: 1, or -1 where it runs along the other strand."""
    name = with_prefix(F.col(chrom)) if prefixed else F.col(chrom)
    pos0 = F.col(position) - 1
    hit = (
        (F.col("_chrom") == F.col("_t_chrom")) & (F.col("_bin") == F.col("_t_bin"))
        & (F.col("_pos0") >= F.col("_p_start")) & (F.col("_pos0") < F.col("_p_end"))
    )
    table = pieces.select(
        F.col("t_chrom").alias("_t_chrom"), F.col("bin").alias("_t_bin"),
        F.col("p_start").alias("_p_start"), F.col("p_end").alias("_p_end"),
        F.replace(F.col("q_chrom"), F.lit("chr"), F.lit("")).alias(to_chrom),
        F.col("origin").alias("_origin"), F.col("step").alias("_step"),
    )
    step = {to_step: F.col("_step")} if to_step else {}
    return (
        df.withColumns({"_chrom": name, "_bin": F.shiftright(pos0, bin_bits), "_pos0": pos0})
        .join(table, hit, "left")
        .withColumns({to_position: F.col("_origin") + F.col("_step") * F.col("_pos0") + 1} | step)
        .drop("_chrom", "_bin", "_pos0", "_t_chrom", "_t_bin", "_p_start", "_p_end", "_origin", "_step")
    )


_BASES = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
_PAIRS = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"


def reverse_complement(allele: Column) -> Column:
    """The bases of the other strand, read the other way; "-" stays."""
    return F.reverse(F.translate(allele, _BASES, _PAIRS))


def on_other_strand(start: Column, end: Column, ref: Column, alt: Column) -> dict[str, Column]:
    """A variant whose lifted positions run backwards, as it is read along the target: ``start``
    is where its first base went, ``end`` its last.

    Positions change places and alleles are reverse-complemented. An allele that begins with the base before the
    change ("A" to "AT") would now end with it. That base is left out, and the change is given as "-" between or
    in place of the bases proper. A missing end stays missing.
    """
    anchored = (
        (F.length(ref) != F.length(alt)) & (F.least(F.length(ref), F.length(alt)) == 1)
        & (F.substring(ref, 1, 1) == F.substring(alt, 1, 1)) & (ref != "-"))
    added = anchored & (F.length(ref) == 1)
    removed = anchored & (F.length(alt) == 1)

    def turned(allele: Column) -> Column:
        rest = F.substring(allele, 2, 1 << 30)
        return F.when(anchored, F.when(F.length(allele) == 1, "-").otherwise(reverse_complement(rest))).otherwise(
            reverse_complement(allele))

    return {
        "start_position": F.when(added, start - 1).otherwise(F.coalesce(end, start)),
        "end_position": F.when(added, start).when(removed & end.isNotNull(), start - 1).when(end.isNotNull(), start),
        "reference_allele": turned(ref),
        "variant_allele": turned(alt),
    }


def lift_variants(variants: DataFrame, blocks: DataFrame, bin_bits: int = BIN_BITS,
                  prefixed: bool = True, broadcast_pieces: int = BROADCAST_PIECES,
                  strand_aware: bool = False) -> DataFrame:
    """I4: lift start and end independently and set the build.

    Rows are unmapped when the start has no hit or the end lands on another
    chromosome; those keep their coordinates. A missing hit of the end alone
    leaves a null end. Rows of other builds pass through unchanged.
    ``lift_outcome`` is lifted, unmapped or cross_chromosome, null if not lifted.

    With ``strand_aware``, variants on chains of the other strand are turned (``on_other_strand``),
    and those whose ends went to different strands are unmapped, with the outcome strand_change.

    Up to ``broadcast_pieces`` pieces, no variant is shuffled; beyond, both joins
    shuffle by (chromosome, bin) and hot positions are split.
    """
    columns = variants.columns
    is_source = F.col("reference_genome").eqNullSafe(vocab.BUILD_SOURCE)
    pieces = checked_broadcast(best_pieces(blocks, bin_bits), broadcast_pieces, beyond="merge")
    started = lift_position(variants.where(is_source), pieces, "chromosome", "start_position",
                            "_s_chrom", "_s_pos", bin_bits, prefixed, "_s_step")
    ended = lift_position(started, pieces, "chromosome", "end_position",
                          "_e_chrom", "_e_pos", bin_bits, prefixed, "_e_step")
    # A hit of the end with no hit of the start counts as another chromosome.
    crossed = F.col("_e_chrom").isNotNull() & ~F.col("_e_chrom").eqNullSafe(F.col("_s_chrom"))
    torn = F.lit(strand_aware) & F.coalesce(F.col("_e_step") != F.col("_s_step"), F.lit(False))
    lifted = F.col("_s_chrom").isNotNull() & ~crossed & ~torn
    moved = {"chromosome": F.col("_s_chrom"), "start_position": F.col("_s_pos"), "end_position": F.col("_e_pos")}
    if strand_aware:
        turned = on_other_strand(
            F.col("_s_pos"), F.col("_e_pos"), F.col("reference_allele"), F.col("variant_allele"))
        moved |= {c: F.when(F.col("_s_step") < 0, v).otherwise(moved.get(c, F.col(c))) for c, v in turned.items()}
    new = {c: F.when(lifted, v).otherwise(F.col(c)) for c, v in moved.items()}
    new["reference_genome"] = F.when(lifted, vocab.BUILD_TARGET).otherwise(vocab.BUILD_UNMAPPED)
    outcome = F.when(crossed, "cross_chromosome").when(torn, "strand_change").when(lifted, "lifted").otherwise("unmapped")
    done = ended.select(
        *[new[c].alias(c) if c in new else F.col(c) for c in columns], outcome.alias("lift_outcome"))
    return done.unionByName(
        variants.where(~is_source).withColumn("lift_outcome", F.lit(None).cast("string")))


def lift_summary(lifted: DataFrame) -> DataFrame:
    """One row of counts; crossing rows are among the failed."""
    total = F.count("lift_outcome")
    good = F.count_if(F.col("lift_outcome") == "lifted")
    return lifted.agg(
        total.alias("total"), good.alias("lifted"), (total - good).alias("failed"),
        F.count_if(F.col("lift_outcome") == "cross_chromosome").alias("cross_chromosome"),
        F.round(F.try_divide(good * 100.0, total), 1).alias("pct_lifted"),
    )
