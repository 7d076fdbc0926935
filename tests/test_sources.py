"""File sources: comments, junk rows, headers, wide matrices."""

import gzip
import math
import time

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import vocab
from cohortloom.functions.clean import parse_double
from cohortloom.operators.reshape import explode_samples, first_known, line_scores
from cohortloom.sources import delimited as d
from cohortloom.sources.matrix import column_map, read_matrix, unique_lines, with_sample_values
from conftest import rows


@pytest.fixture
def small_splits(spark):
    """Make even tiny files span many scan tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


TSV = "#c one\n#c two\nA\tB.x\tC\n1\t\tNA\n#inside\n 2\t\"q\"\"t\"\tz\n"


def test_table(spark, write):
    df = d.read_table(spark, write("t.txt", TSV))
    assert df.columns[:3] == ["A", "B.x", "C"]
    assert {f.dataType.simpleString() for f in df.schema.fields[:3]} == {"string"}
    assert rows(df.select("A", d.col_or_null(df, "B.x"), "C", d.col_or_null(df, "D"))) == [
        (" 2", 'q"t', "z", None), ("1", None, "NA", None)]


def test_gzip(spark, tmp_path):
    path = tmp_path / "t.tsv.gz"
    path.write_bytes(gzip.compress(TSV.encode()))
    assert d.read_table(spark, str(path)).count() == 2


def test_line_order_follows_the_file(spark, write, small_splits):
    path = write("n.txt", "n\n" + "".join(f"{i}\n" for i in range(500)))
    df = d.read_table(spark, path)
    assert df.rdd.getNumPartitions() > 4
    assert [int(r[0]) for r in df.orderBy(*d.LINE_ORDER).select("n").collect()] == list(range(500))


def test_biotab_drops_two_rows_of_every_file(spark, tmp_path, small_splits):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        body = "".join(f"{k}-{i}\tv\n" for i in range(40))
        (folder / f"f{k}.txt").write_text(f"id\tv\njunk\tj\nCDE_ID:1\tCDE\n{body}")
    got = d.read_biotab(spark, str(folder))
    assert rows(got, "id") == sorted(((f"{k}-{i}",) for k in range(3) for i in range(40)), key=str)


def test_scans_are_split_alike_whatever_the_parallelism(spark, write, monkeypatch):
    """Between two scans of one file the executors may come or go."""
    path = write("p.txt", "n\n" + "".join(f"{i}\n" for i in range(500)))
    settings = ("spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        spark.conf.set(settings[0], "1")
        first = rows(d.read_table(spark, path), "n", *d.LINE_ORDER)
        spark.conf.set(settings[1], "2")
        assert rows(d.read_table(spark, path), "n", *d.LINE_ORDER) == first
        # Not pinned, the same lines get other places.
        spark.conf.unset(settings[2])
        monkeypatch.setattr(d, "pin_splits", lambda _: None)
        assert rows(d.read_table(spark, path), "n", *d.LINE_ORDER) != first
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_biotab_with_fewer_rows_than_junk(spark, write):
    assert d.read_biotab(spark, write("s.txt", "id\nonly\n")).count() == 0


def test_missing_source(spark, tmp_path):
    assert not d.exists(spark, None) and not d.exists(spark, str(tmp_path / "no"))
    assert d.preferred(spark, str(tmp_path / "no"), str(tmp_path)) == str(tmp_path)
    empty = d.empty_source(spark, ["a"])
    assert empty.columns == ["a", *d.LINE_ORDER] and empty.count() == 0


def test_header_aliases(spark):
    df = spark.createDataFrame([("g", None, "s"), ("h", "t", "s")], "Hugo_Symbol string, "
                               "Tumor_Sample_Barcode string, SAMPLE_ID string")
    assert rows(d.rename_headers(df, vocab.VARIANT_HEADERS), "gene", "barcode") == [("g", "s"), ("h", "t")]


MATRIX = ("# comment\nHugo_Symbol\tEntrez_Gene_Id\tS-1\tS-2\tS-1\n"
          "A\t1\t1.0\t2.0\t3\nB\t2\tNA\t\t4\nA\t9\t9\t9\t9\n\t5\t1\t1\t1\nnan\t6\t1\t1\t1\n")


def test_matrix(spark, write, small_splits):
    m = read_matrix(spark, write("m.txt", MATRIX))
    assert rows(m.header) == [(2, "S-1"), (3, "S-2"), (4, "S-1")]
    assert rows(m.lines, "label", "entrez_text") == [("A", "1"), ("A", "9"), ("B", "2"), ("nan", "6"), (None, "5")]
    assert rows(unique_lines(m.lines), "label", "entrez_text") == [("A", "1"), ("B", "2"), ("nan", "6"), (None, "5")]


def test_matrix_label_falls_back_to_the_first_column(spark, write):
    m = read_matrix(spark, write("m.txt", "Entrez_Gene_Id\tGene\tS1\n7\tX\t1\n"), label="Hugo_Symbol")
    assert rows(m.lines, "label", "entrez_text") == [("X", "7")]
    assert rows(m.header) == [(2, "S1")]


def test_matrix_without_rows(spark, write):
    assert read_matrix(spark, write("m.txt", "Hugo_Symbol\tS1\n")).lines.count() == 0
    assert read_matrix(spark, write("e.txt", "")).header.count() == 0


def test_matrix_with_many_lines_keeps_the_first(spark, write, small_splits):
    text = "Hugo_Symbol\tS1\n" + "".join(f"G{i % 7 if i % 3 else 0}\t{i}\n" for i in range(200))
    first = {}
    for i in range(200):
        first.setdefault(f"G{i % 7 if i % 3 else 0}", str(i))
    m = read_matrix(spark, write("m.txt", text))
    got = unique_lines(m.lines).select("label", F.split("value", "\t")[1].alias("v"))
    assert dict(rows(got)) == first


def test_plain_and_other_lines_read_cells_alike(spark, write):
    cells = ["1", "-2.5", "1e3", "NA", "", "5.", "+-1", "A", "N1", "1E", "+.5"]
    odd = [*cells[:-1], "1d", "0x1p3", " 7", "nan", "inf"]
    text = "\t".join(["G", *(f"s{i}" for i in range(15))]) + "\n"
    m = read_matrix(spark, write("m.txt", text + "\t".join(["P", *cells]) + "\n" + "\t".join(["Q", *odd]) + "\n"), None)
    columns = column_map(m.header, F.col, m.header.select(F.col("sample").alias("sample_id")))
    strict = [1.0, -2.5, 1000.0, None, None, 5.0, None, None, None, None]
    got = {}
    for label, sample, value in rows(explode_samples(
            with_sample_values(m.lines, columns, parse_double, "double"), first_known(), ["label"])):
        got.setdefault(label, {})[int(sample[1:])] = value
    assert [got["P"][i] for i in range(11)] == [*strict, 0.5]
    assert [got["Q"][i] for i in range(13)] == [*strict, None, None, None]
    assert math.isnan(got["Q"][13]) and got["Q"][14] == math.inf
    assert [got["P"][i] for i in range(11, 15)] == [None] * 4


def test_wide_lines_are_linear(spark, write):
    """One long line: a per-cell split of the line would take minutes."""
    n = 6000
    text = "G\t" + "\t".join(f"s{i}" for i in range(n)) + "\n" + "".join(
        f"g{k}\t" + "\t".join(str(i % 10) for i in range(n)) + "\n" for k in range(20))
    m = read_matrix(spark, write("w.txt", text), None)
    columns = column_map(m.header, F.col, m.header.select(F.col("sample").alias("sample_id")))
    scored = line_scores(with_sample_values(m.lines, columns, parse_double, "double"))
    start = time.time()
    assert explode_samples(scored, first_known(), ["label", "mean"]).where("round(mean, 9) = 4.5").count() == 20 * n
    assert time.time() - start < 30


def test_a_gzip_file_is_parsed_by_many_tasks(spark, tmp_path, monkeypatch, small_splits):
    """One stream of a compressed file becomes chunks; the rows and their order are those of the plain file."""
    body = "".join(f'{i}\t"q ""{i}"" x"\t\tk{i}\textra\n' if i % 9 else f"#note {i}\n\n{i}\t\"\"\n" for i in range(3000))
    text = f"# top\n\nid\tname\tvoid\tkey\n{body}"
    plain, packed = tmp_path / "t.tsv", tmp_path / "t.tsv.gz"
    plain.write_text(text)
    packed.write_bytes(gzip.compress(text.encode()))
    monkeypatch.setattr(d, "CHUNK_LINES", 400)
    want, got = d.read_table(spark, str(plain)), d.read_table(spark, str(packed))
    assert got.columns == want.columns
    chunks = got.select(F.spark_partition_id()).distinct().count()
    assert chunks > 4 and len(got.inputFiles()) > 4
    names = ["id", "name", "void", "key"]
    both = [[tuple(r) for r in df.orderBy(*d.LINE_ORDER).select(*names).collect()] for df in (want, got)]
    assert both[0] == both[1] and len(both[0]) == 3000
    # Without comments, as the first rows of a biotab file are skipped.
    plain.write_text("id\tv\njunk\tj\nCDE\tc\n" + "".join(f"#{i}\tv\n" for i in range(900)))
    packed.write_bytes(gzip.compress(plain.read_bytes()))
    assert rows(d.read_biotab(spark, str(packed)), "id", "v") == rows(d.read_biotab(spark, str(plain)), "id", "v")
    packed.write_bytes(gzip.compress(b""))
    assert d.read_table(spark, str(packed)).count() == 0


def test_a_gzip_matrix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(d, "CHUNK_LINES", 2)
    path = tmp_path / "m.txt.gz"
    path.write_bytes(gzip.compress(MATRIX.encode()))
    m = read_matrix(spark, str(path))
    assert rows(m.header) == [(2, "S-1"), (3, "S-2"), (4, "S-1")]
    assert rows(unique_lines(m.lines), "label", "entrez_text") == [("A", "1"), ("B", "2"), ("nan", "6"), (None, "5")]


def cells_of(m):
    texts = F.split("value", "\t")
    cells = m.lines.crossJoin(m.header).select("label", "entrez_text", "sample", F.get(texts, F.col("pos")).alias("v"))
    return sorted((r["label"], r["entrez_text"], r["sample"], r["v"]) for r in cells.where("v <> ''").collect())


def test_part_files_with_their_own_headers(spark, tmp_path):
    """Shuffled, missing, additional and repeated columns give the cells of one file."""
    parts = tmp_path / "parts"
    parts.mkdir()
    (parts / "a.txt").write_text("# c\nHugo_Symbol\tEntrez_Gene_Id\tS1\tS2\tS1\nA\t1\ta1\ta2\ta3\n")
    (parts / "b.txt").write_text("S2\tS1\tS1\tHugo_Symbol\tEntrez_Gene_Id\nb2\tb1\tb3\tB\t2\n")
    (parts / "c.txt").write_text("Hugo_Symbol\tS9\tS1\nC\tc9\tc1\nD\td9\n")
    (parts / "d.txt").write_text("Hugo_Symbol\tEntrez_Gene_Id\tS1\tS2\tS1\nE\t5\te1\te2\te3\n")
    (parts / "e.txt").write_text("# nothing\n")
    m = read_matrix(spark, str(parts))
    assert rows(m.header) == [(2, "S1"), (3, "S2"), (4, "S1"), (5, "S9")]
    assert [tuple(r) for r in m.lines.orderBy(*d.LINE_ORDER).select("label", "entrez_text").collect()] == [
        ("A", "1"), ("B", "2"), ("C", ""), ("D", ""), ("E", "5")]
    one = tmp_path / "one.txt"
    one.write_text("Hugo_Symbol\tEntrez_Gene_Id\tS1\tS2\tS1\tS9\nA\t1\ta1\ta2\ta3\nB\t2\tb1\tb2\tb3\n"
                   "C\t\tc1\t\t\tc9\nD\t\t\t\t\td9\nE\t5\te1\te2\te3\n")
    assert cells_of(m) == cells_of(read_matrix(spark, str(one)))


def test_part_files_with_one_header_keep_their_lines(spark, tmp_path):
    parts = tmp_path / "same"
    parts.mkdir()
    for k in range(3):
        (parts / f"{k}.txt").write_text(f"Hugo_Symbol\tS1\nG{k}\t{k}\n")
    m = read_matrix(spark, str(parts))
    assert rows(m.lines, "label", "value") == [(f"G{k}", f"G{k}\t{k}") for k in range(3)]
    assert "Join" not in m.lines._jdf.queryExecution().optimizedPlan().toString()
