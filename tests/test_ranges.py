"""Large files read by ranges: the same rows as the whole reader, wherever the file is cut."""

import json
import random

import pytest
from conftest import rows

from feedloom.plans.specs import Route
from feedloom.sources import files as src
from feedloom.sources import ranges
from feedloom.sources.snapshots import read_json_array

CELLS = ["plain", "", "two\nlines", "a\n\n\nb", 'say "hi"', 'x,"y"\n",z', "\r\n", "é ☃", " 5 ", '"', '""\n""', "NA", "end\n"]


@pytest.fixture
def cut_at(spark, monkeypatch):
    """Every file is large, and cut into ranges of so many bytes."""
    real = ranges.pieces

    def setting(size):
        def pieces(spark, paths, separator):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            try:
                return ranges.cut(real(spark, paths, separator).coalesce(2))
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")

        monkeypatch.setattr(ranges, "pieces", pieces)
        spark.conf.set("feedloom.rangeBytes", "0")

    yield setting
    spark.conf.unset("feedloom.rangeBytes")


def quoted(cell):
    return '"' + cell.replace('"', '""') + '"' if any(c in cell for c in ',"\n\r') else cell


def written(folder, name, lines, end="\n"):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as f:
        f.write(end.join(",".join(map(quoted, line)) for line in [["a", "b", "c"], *lines]) + end)


def scanned(spark, root):
    (table,) = src.read_routes(spark, str(root), [Route("r", "in/*.csv", "t", keep_tokens=True)], "1").values()
    return rows(table.select("a", "b", "c", "source_file", "row_id"), "row_id")


@pytest.mark.parametrize("size", [3, 7, 16, 64, 1000])
def test_quoted_breaks_at_every_cut(spark, tmp_path, cut_at, size):
    rng = random.Random(size)
    for i, end in enumerate(("\n", "\r\n")):
        written(tmp_path / "in", f"f{i}.csv", [[rng.choice(CELLS) for _ in "abc"] for _ in range(8)], end)
    written(tmp_path / "in", "plain file.csv", [["1", 'x "y"', "z, q"], ["", "", "2"]])
    want = scanned(spark, tmp_path)
    cut_at(size)
    ways = ranges.survey(spark, [str(p) for p in (tmp_path / "in").iterdir()])
    assert [len(x) for x in (ways.lines, ways.records, ways.whole)] == [1, 2, 0]
    assert scanned(spark, tmp_path) == want and len(want) == 18


@pytest.mark.parametrize("text", ['a,b,c\n5" pipe,x,y\n1,2,3\n', 'a,b,c\n5",6",x\n1,"2\n3",4\n', 'a,b,c\nx"y,"p\nq",1\n', 'a,b,c\n"a"b,"c""d"e,"f\ng"\n1,2,3\n'])
def test_stray_quotes_read_like_the_whole(spark, tmp_path, cut_at, text):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.csv").write_text(text)
    want = scanned(spark, tmp_path)
    cut_at(5)
    assert scanned(spark, tmp_path) == want


def test_a_file_that_ends_in_a_cell_is_malformed(spark, tmp_path, cut_at):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "broken.csv").write_text('a,b,c\n1,"open,2\n4,5,6\n')
    cut_at(4)
    with pytest.raises(Exception, match="broken.csv"):
        scanned(spark, tmp_path)


@pytest.mark.parametrize("text", ['a,b,c\n1,2\n"x\ny",2,3\n', 'a,b,c\n1,2,3,4\n"x\ny",2,3\n'])
def test_wrong_widths_fail_with_the_name(spark, tmp_path, cut_at, text):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.csv").write_text(text)
    cut_at(4)
    with pytest.raises(Exception, match="f.csv"):
        scanned(spark, tmp_path)


OBJECTS = [
    {"polNo": "1", "upline": "a } b"}, {"polNo": 2, "upline": {"x": [{"y": "}{"}], "z": {}}}, {}, {"polNo": None, "extra": "]"},
    {"polNo": 'say \\"{\\" and "}"', "upline": "\\\\"}, {"polNo": "é\n☃", "upline": [1, {"a": 2}]}, {"upline": "long " * 20},
]


@pytest.mark.parametrize("size, indent", [(2, None), (3, 1), (10, None), (41, 1), (200, None)])
def test_json_objects_at_every_cut(spark, tmp_path, cut_at, size, indent):
    (tmp_path / "one.json").write_text("\ufeff" + json.dumps(OBJECTS * 2, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "two.json").write_text(" [ ] \n")
    read = lambda: sorted(map(str, read_json_array(spark, str(tmp_path / "*.json"), ["polNo", "upline"]).collect()))
    want = read()
    cut_at(size)
    assert read() == want and len(want) == 14


@pytest.mark.parametrize("text", ['[{"polNo": 1}, 5, {"polNo": 2}]', '[{"polNo": 1} {"polNo": 2', '[{"polNo": }]'])
def test_broken_arrays_fail(spark, tmp_path, cut_at, text):
    (tmp_path / "p.json").write_text(text)
    cut_at(4)
    with pytest.raises(Exception, match="(?i)p.json|malformed"):
        read_json_array(spark, str(tmp_path / "p.json"), ["polNo"]).collect()


def test_small_ranges_are_neither_tasks_nor_stored_files(spark, tmp_path):
    """What is stored of a text cut into hundreds of ranges is a few files, and is read in few tasks."""
    (tmp_path / "one.json").write_text(json.dumps(OBJECTS * 40))
    spark.conf.set("feedloom.cutBytes", "50")
    try:
        with ranges.cutting(spark):
            found = ranges.cut(ranges.pieces(spark, [str(tmp_path / "one.json")], "}"))
        assert found.select("range").distinct().count() > 100
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        spark.conf.set("feedloom.rangeBytes", "0")
        assert read_json_array(spark, str(tmp_path / "one.json"), ["polNo"]).count() == 280
    finally:
        spark.conf.unset("feedloom.cutBytes")
        spark.conf.unset("feedloom.rangeBytes")
