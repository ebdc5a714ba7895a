"""Records with line breaks in quotes, from files cut into small splits."""

import csv
import random

import pyarrow.parquet as pq
import pytest

from gaugeworks.schemas import FILE_ORDER, MALFORMED
from gaugeworks.session import setting
from gaugeworks.sources import records
from gaugeworks.sources.files import scan_source
from gaugeworks.sources.spec import SourceSpec

MAPPING = {"unique_id": "unique_id", "name": "name", "data_value": "data_value"}


def _write(path, rows, header, end="\r\n"):
    with open(path, "w", encoding="utf-8", newline="") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


def _scan(spark, path, **options):
    return scan_source(spark, SourceSpec(path=str(path), mapping=MAPPING, **options))


def _rows(df):
    return [tuple(r) for r in df.orderBy(*FILE_ORDER).select("unique_id", "name", "data_value", MALFORMED).collect()]


def _texts(n, seed):
    rnd = random.Random(seed)
    parts = ["a", "é", ",", '"', "\n", "\r\n", '""', "\n\n", "word ", '"\n']
    texts = ["x" + "".join(rnd.choices(parts, k=rnd.randrange(12))) + "." for _ in range(n)]
    texts[n // 2] = "long\n" * 400 + "end"  # over many splits
    return texts


def test_small_splits_equal_whole_files(spark, tmp_path):
    rows = [[str(i), text, f"{i}.5"] for i, text in enumerate(_texts(300, 1))]
    _write(tmp_path / "a.csv", rows, ["Unique ID", "Name", "Data Value"])
    _write(tmp_path / "b.csv", [[v, t, f"b{i}", "more"] for i, t, v in rows[:50]], ["Data Value", "Name", "Unique ID"], "\n")
    with setting(spark, "spark.sql.files.maxPartitionBytes", "300"), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        found = _scan(spark, tmp_path, quoted_breaks=True)
        assert found.select("_file", "_block").distinct().count() > 20
        wanted = [(i, t, v, None) for i, t, v in rows] + [(f"b{i}", t, v, "more") for i, t, v in rows[:50]]
        assert _rows(found) == wanted
    # The unsplittable way turns CRLF in values into LF.
    whole = _rows(_scan(spark, tmp_path / "a.csv", multiline=True))
    assert whole == [(i, t.replace("\r\n", "\n"), v, None) for i, t, v, _ in wanted[:300]]


def test_order_no_header_and_blank_rows(spark, tmp_path):
    (tmp_path / "c.csv").write_text('1,"a\nb",2\n\n   \n3,c\n4,"",5,6\n', encoding="utf-8")
    found = _scan(spark, tmp_path / "c.csv", quoted_breaks=True, has_header=False)
    assert [(a, b or None, c, d) for a, b, c, d in _rows(found)] == [("1", "a\nb", "2", None), ("3", "c", None, None), ("4", None, "5", "6")]


def test_empty_and_broken(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert _scan(spark, tmp_path / "e.csv", quoted_breaks=True).count() == 0
    (tmp_path / "f.csv").write_text('Unique ID,Name\n1,"open\n')
    with pytest.raises(ValueError, match="ends inside a quoted field"):
        _scan(spark, tmp_path / "f.csv", quoted_breaks=True)
    (tmp_path / "g.csv").write_text("other\n1\n")
    with pytest.raises(ValueError, match="none of the columns"):
        _scan(spark, tmp_path / "g.csv", quoted_breaks=True)
    with pytest.raises(ValueError, match="UTF-8"):
        _scan(spark, tmp_path / "g.csv", quoted_breaks=True, encoding="latin-1")


def test_lines_of_one_split_go_to_many_tasks(spark, tmp_path):
    rows = [[str(i), f'n "{i}"\n.' if i % 3 else "n", "1"] for i in range(20_000)]
    _write(tmp_path / "h.csv", rows, ["Unique ID", "Name", "Data Value"])
    off = setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    with off, setting(spark, "spark.sql.files.openCostInBytes", "64m"):
        found = _scan(spark, tmp_path / "h.csv", quoted_breaks=True)
        assert found.select("_block").distinct().count() == 1
    counts = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in found.inputFiles() if "/lines-" in f]
    assert sum(counts) == 20_000 + 13_333 + 1
    assert max(counts) < sum(counts) / 2
    assert _rows(found) == [(i, t, v, None) for i, t, v in rows]


def test_small_chunks_and_many_files_in_a_chunk(spark, tmp_path, monkeypatch):
    texts = _texts(40, 2)
    texts[20] = "long\n" * 40 + '"end'
    wanted = [(str(i), text, "1", None) for i, text in enumerate(texts)]
    _write(tmp_path / "one.csv", [r[:3] for r in wanted], ["Unique ID", "Name", "Data Value"])
    monkeypatch.setattr(records, "CHUNK_BITS", 1)
    with setting(spark, "spark.sql.files.openCostInBytes", "64m"):
        assert _rows(_scan(spark, tmp_path / "one.csv", quoted_breaks=True)) == wanted
    monkeypatch.undo()

    (tmp_path / "many").mkdir()
    wanted = []
    for i in range(40):  # as long, so that eight scans get five whole files each
        rows = [[f"{i:02d}", 'a\n"b",\n', "1"], ["2", "c", "3\n"]] if i % 2 else [["3", 'cd\n""', f"{i:02d}"], ["5", '"\n', "6"]]
        head = ["Unique ID", "Name", "Data Value"] if i % 3 else ["Data\n Value", "Name", "Unique ID"]
        _write(tmp_path / "many" / f"{i:02d}.csv", rows, head, "\n")
        file = tmp_path / "many" / f"{i:02d}.csv"
        file.write_bytes(b"\n" * (100 - file.stat().st_size) + file.read_bytes())
        wanted += [(a, b, c if i % 3 else None, None) if i % 3 else (c, b, None, None) for a, b, c in rows]
    with setting(spark, "spark.sql.files.openCostInBytes", "0"):
        found = _scan(spark, tmp_path / "many", quoted_breaks=True)
        partition = found.selectExpr("_row >> 33 as p").distinct().count()
        assert partition < 40
        assert _rows(found) == wanted
