import pytest

from filedrop.sources.layout import Layout, LayoutError, layout_from_frame, load_layout


@pytest.mark.parametrize("fields", [
    [], [("a", 0, 1)], [("a", 1, 0)], [("date", 1, 1)], [("HOUR", 1, 1)], [("chunk", 1, 1)],
    [("a", 1, 1), ("A", 2, 1)], [("", 1, 1)], [("a", None, 1)], [("drop_file", 1, 1)],
])
def test_unusable_layouts_are_rejected(fields):
    with pytest.raises(LayoutError):
        Layout(fields)


def test_required_columns(spark):
    with pytest.raises(LayoutError, match="Length"):
        layout_from_frame(spark.createDataFrame([("a", 1)], "Column string, Starting_Index int"))
    with pytest.raises(LayoutError):
        layout_from_frame(spark.createDataFrame([("a", "x", 1)], "Column string, Starting_Index string, Length int"))


def test_sheets_in_several_formats(spark, tmp_path):
    rows = [(f"f{i}", 1 + 3 * i, 3) for i in range(60)]
    df = spark.createDataFrame(rows, "Column string, Starting_Index int, Length int").coalesce(1)
    df.write.option("header", True).csv(str(tmp_path / "sheet.csv"))
    df.write.json(str(tmp_path / "sheet.json"))
    df.write.parquet(str(tmp_path / "sheet.parquet"))
    for kind in ("csv", "json", "parquet"):
        layout = load_layout(spark, str(tmp_path / f"sheet.{kind}"))
        assert [(f.name, f.start, f.length) for f in layout] == rows
    assert layout.table_schema.names[-2:] == ["date", "hour"]
    assert {f.dataType.simpleString() for f in layout.schema} == {"string"}
