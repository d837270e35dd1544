import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from admitflow.sources import extracts, spliced


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield spark
    for name in names:
        spark.conf.unset(name)


def made(rows, seed, line_end="\n", quoting=csv.QUOTE_MINIMAL):
    rng = random.Random(seed)
    words = ["plain", "two\nlines", "x\r\ny", 'say "hi"', '"', "a,b", "", "\n", "é字", '""\n""', "1", 'end"\n', "\n\n,\n"]
    table = [[str(i), rng.choice(words), "".join(rng.choice(words) for _ in range(rng.randint(0, 4)))] for i in range(rows)]
    out = io.StringIO()
    csv.writer(out, lineterminator=line_end, quoting=quoting).writerows([["id", "note", "more"], *table])
    return out.getvalue(), [tuple(value or None for value in row) for row in table]


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: int(r[0]))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_a_file_with_line_breaks_is_read_by_many_tasks(small_splits, tmp_path, seed, quoting):
    text, expected = made(150, seed, quoting=quoting)
    path = tmp_path / "a.csv"
    path.write_bytes(text.encode())
    layout = spliced.look(small_splits, str(path))
    assert layout.line_breaks and layout.separable
    assert layout.splits.count() > 8 and layout.splits.where("inside").count() > 1
    df = extracts.read_csv(small_splits, str(path))
    assert df.columns == ["id", "note", "more"] and {t for _, t in df.dtypes} == {"string"}
    assert values(df) == expected
    records = spliced.records(small_splits, str(path), layout)
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 8


def test_windows_line_ends_and_blank_lines(small_splits, tmp_path):
    text, expected = made(100, 9, line_end="\r\n")
    path = tmp_path / "a.csv"
    path.write_bytes(("\r\n\r\n" + text.replace("\r\n1,", "\r\n\r\n1,", 1) + "\r\n").encode())
    assert spliced.look(small_splits, str(path)).separable
    assert values(extracts.read_csv(small_splits, str(path))) == expected


def test_many_files_and_a_last_line_without_an_end(small_splits, tmp_path):
    folder, expected = tmp_path / "parts.csv", []
    folder.mkdir()
    for part in range(4):
        text, rows = made(30, part)
        rows = [(str(int(i) + 1000 * part), *rest) for i, *rest in rows]
        body = io.StringIO()
        csv.writer(body, lineterminator="\n").writerows([["id", "note", "more"], *[[v or "" for v in r] for r in rows]])
        (folder / f"{part}.csv").write_bytes(body.getvalue().removesuffix("\n").encode())
        expected += rows
    assert values(extracts.read_csv(small_splits, str(folder))) == expected


def test_another_header_and_malformed_records_raise(small_splits, tmp_path):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    (folder / "0.csv").write_text('id,note\n1,"a\nb"\n')
    (folder / "1.csv").write_text('id,other\n2,"a\nb"\n')
    with pytest.raises(Exception, match="another header"):
        extracts.read_csv(small_splits, str(folder)).collect()
    short = tmp_path / "short.csv"
    short.write_text('id,note\n1,"a\nb"\n2\n')
    with pytest.raises(Exception, match="MALFORMED"):
        extracts.read_csv(small_splits, str(short)).collect()


@pytest.mark.parametrize(
    "text, expected",
    [
        ('id,note\n1,5" pipe\n2,"two\nlines"\n', [("1", '5" pipe'), ("2", "two\nlines")]),
        ('id,note\n1,"' + "long line\n" * 200 + '"\n2,x\n', [("1", "long line\n" * 200), ("2", "x")]),
    ],
)
def test_files_whose_quotes_do_not_tell_are_read_whole(small_splits, tmp_path, text, expected):
    path = tmp_path / "a.csv"
    path.write_text(text)
    layout = spliced.look(small_splits, str(path))
    assert layout.line_breaks and not layout.separable
    assert values(extracts.read_csv(small_splits, str(path))) == expected


def test_a_record_too_long_to_carry_is_not_separable(small_splits, tmp_path):
    text, _ = made(100, 3)
    path = tmp_path / "a.csv"
    path.write_bytes(text.encode())
    assert spliced.look(small_splits, str(path)).separable
    assert not spliced.look(small_splits, str(path), carried=8).separable


def test_no_line_breaks_need_no_splicing(small_splits, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,note\n1,"a, ""b"""\n')
    assert not spliced.look(small_splits, str(path)).line_breaks
    assert values(extracts.read_csv(small_splits, str(path))) == [("1", 'a, "b"')]


@pytest.mark.parametrize("step", [1, 2, 3, 50])
def test_records_of_a_split_come_in_order(step):
    lines = [b"a,b", b'1,"x', b"", b'y"', b"", b"2,z\r", b"\r", b'3,"p', b'"', b'4,"q""', b'r"\r', b'5,"left']
    for inside, expected in [
        (False, [b"a,b", b'1,"x\n\ny"', b"2,z", b'3,"p\n"', b'4,"q""\nr"']),
        (True, [b"a,b", b'1,"x\n\ny"', b"2,z", b'3,"p\n"', b'4,"q""\nr"']),
    ]:
        given = [b"cut", b'off"', *lines] if inside else lines
        records, found = spliced._Records(inside, not inside), []
        for at in range(0, len(given), step):
            batch = records.add(pa.array(given[at : at + step], pa.binary()))
            found += zip(batch.column("record").to_pylist(), batch.column("header").to_pylist())
        assert [r for r, _ in found] == expected
        assert [h for _, h in found] == [not inside] + [False] * 4
