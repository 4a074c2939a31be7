import pytest
from pyspark.errors import PySparkException

from rarecohort.model import COLUMNS, VARIANT_SCHEMA
from rarecohort.sources import vcf
from rarecohort.sources.cohort import read_cohort, write_parsed

FIELDS = ["Allele", "Consequence", "IMPACT", "SYMBOL"]


def header(fields, extra=""):
    return f'##INFO=<ID=CSQ,Number=.,Type=String,Description="VEP{extra}. Format: {"|".join(fields)}">'


def record(info="CSQ=T|stop_gained|HIGH|TP53", fmt="GT:GQ:DP:AD:VAF:PL", sample="0/1:45:120:60,60:0.5:100,0,95", **kw):
    row = dict(CHROM="chr1", POS="100", ID=".", REF="C", ALT="T", QUAL="30.5", FILTER="PASS") | kw
    parts = [*row.values(), info, fmt]
    return "\t".join(parts if sample is None else [*parts, sample])


def write(folder, name, lines, eol="\n"):
    (folder / name).write_bytes(eol.join(lines).encode())


CHROM_LINE = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tsample"


def parse(spark, folder, **kw):
    return [r.asDict() for r in vcf.read_vcf(spark, str(folder), **kw).orderBy("Patient_ID", "POS", "SYMBOL").collect()]


@pytest.mark.parametrize("name", ["Case1_F", "Case 1+F", "a+b", "a.vcf.b", "50%"])
def test_columns_and_values(spark, tmp_path, name):
    write(tmp_path, name + ".vcf", ["##fileformat=VCFv4.2", header(FIELDS), CHROM_LINE, record()])
    df = vcf.read_vcf(spark, str(tmp_path))
    assert df.columns == [*COLUMNS, "extras"]
    assert [f.dataType for f in df.schema][:48] == [f.dataType for f in VARIANT_SCHEMA]
    (row,) = df.collect()
    assert row["Patient_ID"] == name
    assert (row["CHROM"], row["POS"], row["ID"], row["QUAL"], row["FILTER"]) == ("chr1", 100, None, 30.5, "PASS")
    assert [row[f] for f in FIELDS] == ["T", "stop_gained", "HIGH", "TP53"]
    assert [row[f] for f in ("GT", "GQ", "DP", "AD", "VAF", "PL")] == ["0/1", "45", "120", "60,60", "0.5", "100,0,95"]
    assert row["Gene"] is None and row["extras"] is None


def test_transcripts_share_the_sample(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS), record(info="AC=1;CSQ=T|x|LOW|A,T|y|HIGH|B;DB")])
    rows = parse(spark, tmp_path)
    assert [(r["SYMBOL"], r["IMPACT"], r["GT"]) for r in rows] == [("A", "LOW", "0/1"), ("B", "HIGH", "0/1")]


@pytest.mark.parametrize("info", [".", "AC=1", "CSQ=", "CSQ=;AC=1"])
def test_no_annotation_keeps_one_row(spark, tmp_path, info):
    write(tmp_path, "a.vcf", [header(FIELDS), record(info=info)])
    (row,) = parse(spark, tmp_path)
    assert all(row[f] is None for f in FIELDS) and row["GT"] == "0/1"


def test_short_and_empty_parts_are_null(spark, tmp_path):
    write(
        tmp_path,
        "a.vcf",
        [
            header(FIELDS),
            record(info="CSQ=T|x", POS="1"),
            record(info="CSQ=T||LOW|", POS="2"),
            record(sample="./.:.", POS="3"),
            record(sample="0/1::7", POS="4"),
            record(sample=None, POS="5"),
            record(sample="", POS="6"),
        ],
    )
    one, two, three, four, five, six = parse(spark, tmp_path)
    assert [one[f] for f in FIELDS] == ["T", "x", None, None]
    assert [two[f] for f in FIELDS] == ["T", None, "LOW", None]
    assert [three[f] for f in ("GT", "GQ", "DP")] == ["./.", None, None]
    assert [four[f] for f in ("GT", "GQ", "DP")] == ["0/1", None, "7"]
    assert five["GT"] is None and six["GT"] is None


def test_dots_stay_outside_id_and_qual(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS), record(QUAL=".", FILTER=".", ALT=".", REF=".")])
    (row,) = parse(spark, tmp_path)
    assert (row["ID"], row["QUAL"], row["FILTER"], row["ALT"], row["REF"]) == (None, None, ".", ".", ".")


def test_short_lines_go(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS), "\t".join("12345678"), "", record()])
    assert len(parse(spark, tmp_path)) == 1


def test_carriage_returns(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS), CHROM_LINE, record(), record(POS="200")], eol="\r\n")
    rows = parse(spark, tmp_path)
    assert [(r["POS"], r["PL"], r["SYMBOL"]) for r in rows] == [(100, "100,0,95", "TP53"), (200, "100,0,95", "TP53")]


@pytest.mark.parametrize("limit", [64 << 20, 300])
def test_each_file_by_its_own_header(spark, tmp_path, monkeypatch, limit):
    """Headers in one broadcast, and dealt to several: rows are equal, and no text is shuffled."""
    monkeypatch.setattr(vcf, "MAX_HEADER_BYTES", limit)
    write(tmp_path, "a.vcf", [header(FIELDS), record()])
    write(tmp_path, "b.vcf", [header(FIELDS[::-1]), record(info="CSQ=TP53|HIGH|stop_gained|T")])
    write(tmp_path, "c.vcf", [CHROM_LINE, record()])
    a, b, c = parse(spark, tmp_path)
    assert [a[f] for f in FIELDS] == [b[f] for f in FIELDS] == ["T", "stop_gained", "HIGH", "TP53"]
    assert all(c[f] is None for f in FIELDS) and c["GT"] == "0/1"
    plan = vcf.read_vcf(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == (1 if limit > 300 else 2)


def test_same_name_in_two_folders(spark, tmp_path):
    """Each file is read by its own header; one patient in two files must be stated."""
    folders = [tmp_path / "v1", tmp_path / "v2"]
    for folder, fields, csq in zip(folders, (FIELDS, FIELDS[::-1]), ("T|x|HIGH|TP53", "TP53|HIGH|x|T")):
        folder.mkdir()
        write(folder, "a.vcf", [header(fields), record(info=f"CSQ={csq}")])
    with pytest.raises(ValueError, match="patient"):
        vcf.read_vcf(spark, [str(f) for f in folders])
    rows = vcf.read_vcf(spark, [str(f) for f in folders], split_patients=True).collect()
    assert [(r["Patient_ID"], r["SYMBOL"], r["IMPACT"]) for r in rows] == [("a", "TP53", "HIGH")] * 2


def test_unreadable_quality_is_kept(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS), record(QUAL="high"), record(QUAL=".", POS="200")])
    first, second = parse(spark, tmp_path)
    assert (first["QUAL"], first["extras"]) == (None, {"QUAL": "high"})
    assert (second["QUAL"], second["extras"]) == (None, None)


def test_last_header_of_a_file_counts(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS[::-1]), header(FIELDS), record()])
    assert parse(spark, tmp_path)[0]["SYMBOL"] == "TP53"


def test_repeated_names_take_the_last(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(["SYMBOL", "X", "SYMBOL"]), record(info="CSQ=A|x|B", fmt="GT:DP:GT", sample="0/1:7:1/1")])
    write(tmp_path, "b.vcf", [header(["SYMBOL"]), record(info="CSQ=A")])
    a, _ = parse(spark, tmp_path)
    assert (a["SYMBOL"], a["GT"], a["DP"], a["extras"]) == ("B", "1/1", "7", {"X": "x"})


def test_names_off_the_list_are_extras(spark, tmp_path):
    fields = [*FIELDS, "CANONICAL", "SHARED"]
    line = record(
        info="CSQ=T|x|LOW|A|YES|csq,T|x|LOW|B||csq", fmt="GT:MIN_DP:SHARED:SYMBOL:EMPTY", sample="0/1:3:fmt:no:."
    )
    write(tmp_path, "a.vcf", [header(fields), line])
    first, second = parse(spark, tmp_path)
    assert first["extras"] == {"CANONICAL": "YES", "MIN_DP": "3", "SHARED": "fmt"}
    assert second["extras"] == {"MIN_DP": "3", "SHARED": "fmt"}
    assert (first["SYMBOL"], second["SYMBOL"]) == ("A", "B")


def test_stated_layout_needs_no_header(spark, tmp_path):
    write(tmp_path, "a.vcf", [CHROM_LINE, record()])
    assert parse(spark, tmp_path, csq_fields=FIELDS)[0]["SYMBOL"] == "TP53"


def test_no_files(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        vcf.read_vcf(spark, str(tmp_path))


def test_header_without_format(spark, tmp_path):
    write(tmp_path, "a.vcf", ["##INFO=<ID=CSQ,Number=.>", record()])
    with pytest.raises(PySparkException, match="no annotation format"):
        vcf.read_vcf(spark, str(tmp_path)).collect()


def test_position_must_be_a_number(spark, tmp_path):
    write(tmp_path, "a.vcf", [header(FIELDS), record(POS="x")])
    with pytest.raises(PySparkException):
        vcf.read_vcf(spark, str(tmp_path)).select("POS").collect()


def test_large_file_in_many_splits(spark, tmp_path):
    """A file that many tasks read, beside a small one; written by patient and read back."""
    src = tmp_path / "in"
    src.mkdir()
    big = [record(info=f"CSQ=T|x|LOW|G{i % 7},T|x|HIGH|H{i % 5}", POS=str(i + 1)) for i in range(20_000)]
    write(src, "007.vcf", [header(FIELDS), CHROM_LINE, *big])
    write(src, "008.vcf", [header(FIELDS[::-1]), record(info="CSQ=TP53|HIGH|stop_gained|T")])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100kb")
    try:
        parsed = vcf.read_vcf(spark, str(src))
        assert parsed.rdd.getNumPartitions() > 8
        write_parsed(parsed, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    back = read_cohort(spark, str(tmp_path / "out"))
    counts = {r["Patient_ID"]: r["n_rows"] for r in vcf.parsed_row_counts(back).collect()}
    assert counts == {"007": 40_000, "008": 1}
    wrong = back.filter("Patient_ID = '007' AND SYMBOL NOT IN (concat('G', (POS - 1) % 7), concat('H', (POS - 1) % 5))")
    assert wrong.isEmpty()
