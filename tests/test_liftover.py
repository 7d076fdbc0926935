"""Liftover against a brute-force search over blocks."""

import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import liftover as lo
from cohortloom.sources.chain import BLOCK_COLUMNS, read_chain
from conftest import rows

BLOCKS = [
    # chain, score, chromosome, start, end, to, start, size, strand
    (1, 1000, "chr1", 0, 100, "chr1", 500, 10_000, "+"),
    (1, 1000, "chr1", 150, 300, "chr1", 700, 10_000, "+"),
    (2, 2000, "chr1", 180, 220, "chr2", 40, 10_000, "+"),
    (3, 500, "chr7", 10, 60, "chr7", 100, 1000, "-"),
    (4, 900, "chr9", 1000, 200_000, "chr9", 5000, 10**6, "+"),
]
SCHEMA = ("chain_id long, score long, t_chrom string, t_start long, t_end long, "
          "q_chrom string, q_start long, q_size long, strand string")


def best_hit(blocks, chrom, pos0):
    hits = [b for b in blocks if b[2] == chrom and b[3] <= pos0 < b[4]]
    if not hits:
        return None
    b = max(hits, key=lambda b: (b[1], -b[0]))
    q = b[6] + pos0 - b[3]
    return b[5].replace("chr", ""), (q if b[8] == "+" else b[7] - 1 - q) + 1


@pytest.mark.parametrize("bin_bits", [4, 14])
def test_positions_match_brute_force(spark, bin_bits):
    rng = random.Random(7)
    blocks = list(BLOCKS)
    for i in range(60):  # heavily overlapping, every chain its own score or a tie
        s = rng.randrange(0, 4000)
        blocks.append((10 + i, rng.randrange(1, 20), "chr3", s, s + rng.randrange(1, 900), f"chr{i % 4}",
                       rng.randrange(0, 9000), 50_000, rng.choice("+-")))
    points = [("3", p) for p in range(1, 5000, 7)] + [("chr1", p) for p in range(1, 320)]
    points += [("7", p) for p in (10, 11, 60, 61)] + [("9", 1000), ("9", 1001), ("9", 200_000), ("9", 200_001)]
    points += [(None, 5), ("1", None), ("X", 5)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, c string, p long")
    pieces = lo.best_pieces(spark.createDataFrame(blocks, SCHEMA), bin_bits)
    got = {r["i"]: (r["qc"], r["qp"]) for r in lo.lift_position(df, pieces, "c", "p", "qc", "qp", bin_bits).collect()}
    for i, (chrom, pos) in enumerate(points):
        want = None
        if chrom is not None and pos is not None:
            want = best_hit(blocks, chrom if chrom.startswith("chr") else "chr" + chrom, pos - 1)
        assert got[i] == (want or (None, None)), (chrom, pos)


def test_pieces_are_disjoint(spark):
    pieces = rows(lo.best_pieces(spark.createDataFrame(BLOCKS, SCHEMA), 4), "t_chrom", "p_start", "p_end")
    covered = [(c, p) for c, s, e in pieces for p in range(s, e)]
    assert len(covered) == len(set(covered))


VARIANTS = [
    ("both", "1", 11, 21, "GRCh37"), ("no_end", "1", 11, None, "GRCh37"), ("end_lost", "1", 11, 121, "GRCh37"),
    ("start_lost", "1", 121, 161, "GRCh37"), ("crossing", "1", 161, 201, "GRCh37"), ("moved", "1", 201, 205, "GRCh37"),
    ("none", "5", 1, 2, "GRCh37"), ("no_chrom", None, 1, 2, "GRCh37"), ("other", "1", 11, 21, "GRCh38"),
    ("done", "1", 11, 21, "GRCh37_UNMAPPED"),
]


def test_variant_status(spark):
    df = spark.createDataFrame(VARIANTS, "id string, chromosome string, start_position long, "
                                         "end_position long, reference_genome string")
    lifted = lo.lift_variants(df, spark.createDataFrame(BLOCKS, SCHEMA))
    got = {r[0]: tuple(r)[1:] for r in lifted.collect()}
    u = "GRCh37_UNMAPPED"
    assert got == {
        "both": ("1", 511, 521, "GRCh38", "lifted"),
        "no_end": ("1", 511, None, "GRCh38", "lifted"),
        "end_lost": ("1", 511, None, "GRCh38", "lifted"),
        "start_lost": ("1", 121, 161, u, "cross_chromosome"),
        "crossing": ("1", 161, 201, u, "cross_chromosome"),
        "moved": ("2", 61, 65, "GRCh38", "lifted"),
        "none": ("5", 1, 2, u, "unmapped"), "no_chrom": (None, 1, 2, u, "unmapped"),
        "other": ("1", 11, 21, "GRCh38", None), "done": ("1", 11, 21, u, None),
    }
    assert lo.lift_summary(lifted).head().asDict() == {
        "total": 8, "lifted": 4, "failed": 4, "cross_chromosome": 2, "pct_lifted": 50.0}


def test_range_join_is_an_equi_join(spark):
    df = spark.createDataFrame(VARIANTS, "id string, chromosome string, start_position long, "
                                         "end_position long, reference_genome string")
    plan = lo.lift_variants(df, spark.createDataFrame(BLOCKS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


CHAIN = """# comment
chain 1000 chr1 1000 + 0 300 chr1 10000 + 500 850 1
100 50 100
150

chain 500 chr7 200 + 10 60 chr7 1000 - 100 150 3
20\t5\t0
25
"""


def test_chain_file(spark, write):
    blocks = read_chain(spark, write("a.chain", CHAIN))
    assert blocks.columns == BLOCK_COLUMNS
    assert rows(blocks.orderBy("chain_id", "t_start")) == [
        (1, 1000, "chr1", 0, 100, "chr1", 500, 10000, "+"),
        (1, 1000, "chr1", 150, 300, "chr1", 700, 10000, "+"),
        (3, 500, "chr7", 10, 30, "chr7", 100, 1000, "-"),
        (3, 500, "chr7", 35, 60, "chr7", 120, 1000, "-"),
    ]


def test_chain_file_in_many_splits(spark, write):
    text = "".join(
        f"chain {i} chr1 100000 + {i * 100} {i * 100 + 60} chr2 100000 + {i} {i + 60} {i}\n20 20 10\n20\n\n"
        for i in range(1, 200))
    path = write("b.chain", text)
    whole = rows(read_chain(spark, path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        split = read_chain(spark, path)
        assert rows(split) == whole and len(whole) == 398
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(r["t_end"] - r["t_start"] == 20 for r in split.select(F.col("t_start"), F.col("t_end")).collect())


def test_variants_are_turned_on_the_other_strand(spark):
    """Against a made-up genome: the change to the sequence, read on the target, is the same change."""
    import random

    from cohortloom.operators.liftover import lift_variants

    rng = random.Random(3)
    size, ahead = 200, "".join(rng.choice("ACGT") for _ in range(200))
    back = ahead[::-1].translate(str.maketrans("ACGT", "TGCA"))
    blocks = spark.createDataFrame(
        [(1, 9, "chr1", 0, size, "chr1", 0, size, "-"), (2, 9, "chr2", 0, size, "chr2", 0, size, "+")],
        "chain_id long, score long, t_chrom string, t_start long, t_end long, q_chrom string, q_start long, q_size long, strand string")
    made = []
    for k in range(60):
        p, n = rng.randint(20, 150), rng.randint(1, 4)
        one, new = ahead[p - 1:p - 1 + n], "".join(rng.choice("ACGT") for _ in range(n))
        made += [(p, p + n - 1, one, new), (p, p + 1, "-", new), (p, p, ahead[p - 1], ahead[p - 1] + new),
                 (p, p + n - 1, one, "-"), (p, p + n, ahead[p - 1:p + n], ahead[p - 1])]
    points = spark.createDataFrame(
        [(i, c, s, e, r, a, "GRCh37") for i, (s, e, r, a) in enumerate(made) for c in ("1", "2")],
        "i int, chromosome string, start_position long, end_position long, reference_allele string, variant_allele string, "
        "reference_genome string")

    def changed(genome, start, end, ref, alt):
        if ref == "-":
            return genome[:start] + alt + genome[end - 1:]
        assert genome[start - 1:start - 1 + len(ref)] == ref
        return genome[:start - 1] + alt.replace("-", "") + genome[start - 1 + len(ref):]

    lifted = lift_variants(points, blocks, strand_aware=True).collect()
    assert len(lifted) == 2 * len(made) and {r["lift_outcome"] for r in lifted} == {"lifted"}
    for r in lifted:
        want = changed(ahead, *made[r["i"]])
        got = changed(back if r["chromosome"] == "1" else ahead, *(r[c] for c in (
            "start_position", "end_position", "reference_allele", "variant_allele")))
        assert got == (want[::-1].translate(str.maketrans("ACGT", "TGCA")) if r["chromosome"] == "1" else want)
    # Off by default: alleles and the order of positions stay.
    plain = {(r["i"], r["chromosome"]): r for r in lift_variants(points, blocks).collect()}
    assert all(plain[i, "1"]["reference_allele"] == made[i][2] and plain[i, "1"]["end_position"] <= plain[i, "1"]["start_position"]
               for i in range(len(made)))


def test_many_pieces_are_never_broadcast(spark, tmp_path):
    """The file of blocks is small, what is exploded from it is not, and the engine only knows the former."""
    path = str(tmp_path / "blocks")
    spark.range(3000).select(
        F.lit(1).cast("long").alias("chain_id"), F.lit(1).cast("long").alias("score"), F.lit("chr1").alias("t_chrom"),
        (F.col("id") * 50_000).alias("t_start"), (F.col("id") * 50_000 + 40_001).alias("t_end"), F.lit("chr2").alias("q_chrom"),
        (F.col("id") * 50_000 + 7).alias("q_start"), F.lit(10**10).alias("q_size"), F.lit("+").alias("strand")).write.parquet(path)
    blocks = spark.read.parquet(path)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastExchange" not in plan(lo.best_pieces(blocks))
    points = spark.range(20_000).select(
        F.lit("1").alias("chromosome"), (F.col("id") * 7_500 + 1).alias("start_position"),
        (F.col("id") * 7_500 + 2).alias("end_position"), F.lit("GRCh37").alias("reference_genome"))
    lifted = lo.lift_variants(points, blocks, broadcast_pieces=1000)
    assert "Broadcast" not in plan(lifted)
    # Of every 50,000 bases the first 40,001 are covered.
    assert lo.lift_summary(lifted).head().lifted == points.where("(start_position - 1) % 50000 <= 40000").count()
    assert rows(lifted.where("start_position = 7508"), "chromosome", "start_position", "end_position") == [("2", 7508, 7509)]
