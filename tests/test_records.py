import gzip

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from filedrop.functions.records import cast_fields, cut_records, decode_lossy, slice_fields, trim_fields
from filedrop.operators import gunzip
from filedrop.sources.layout import Layout

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
pieces = st.one_of(
    st.binary(max_size=12), st.text(max_size=6).map(lambda t: t.encode("utf-8", "ignore")),
    st.sampled_from([b"\xef\xbf\xbd", b"\xee\x80\x80", b"\xee\x80\x801", b"\xee\x80\x800", b"\xe2\x82", b"\xf0\x9f\x98",
                     b"\x80", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf5", b"\xf4\x90\x80\x80", b"A"]),
)
blobs = st.lists(pieces, max_size=8).map(b"".join)


@few
@given(st.lists(blobs, min_size=40, max_size=80))
def test_lossy_decoding_equals_python(spark, data):
    df = spark.createDataFrame([(bytearray(d),) for d in data], "b binary")
    got = [r["t"] for r in df.select(decode_lossy("b").alias("t")).collect()]
    assert got == [d.decode("utf-8", "ignore") for d in data]


LAYOUT = Layout([("a", 1, 3), ("b", 4, 5), ("c", 9, 40), ("d", 60, 2)])


@few
@given(st.lists(blobs, min_size=40, max_size=80))
def test_slicing_equals_python(spark, data):
    df = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, rec binary")
    by_chars = slice_fields(df, LAYOUT, keep=("i",)).collect()
    by_bytes = slice_fields(df, LAYOUT, mode="bytes", keep=("i",)).collect()
    for chars, bytes_, d in zip(by_chars, by_bytes, data):
        text = d.decode("utf-8", "ignore")
        for f in LAYOUT:
            at = slice(f.start - 1, f.start - 1 + f.length)
            assert chars[f.name] == text[at]
            assert bytes_[f.name] == d[at].decode("utf-8", "ignore")


def test_missing_record_gives_missing_fields(spark):
    df = spark.createDataFrame([(None,)], "rec binary")
    for mode in ("chars", "bytes"):
        assert set(slice_fields(df, LAYOUT, mode=mode).first()) == {None}
    with pytest.raises(ValueError):
        slice_fields(df, LAYOUT, mode="words")


@few
@given(st.lists(st.binary(max_size=40), min_size=10, max_size=30))
def test_native_cutting_equals_gunzip(spark, data):
    rows = [(str(i), bytearray(d), bytearray(gzip.compress(d))) for i, d in enumerate(data)]
    df = spark.createDataFrame(rows, "path string, plain binary, content binary")
    native = cut_records(df.select("path", "plain"), "plain", 7)
    unzipped = gunzip.gunzip_records(df.select("path", "content"), record_bytes=7)
    want = {(str(i), k, d[k * 7:k * 7 + 7]) for i, d in enumerate(data) for k in range(-(-len(d) // 7))}
    assert {(r["path"], r["ord"], bytes(r["rec"])) for r in native.collect()} == want
    assert {(r["path"], r["ord"], bytes(r["rec"])) for r in unzipped.collect()} == want


def test_null_content_gives_no_records(spark):
    df = spark.createDataFrame([("a", None), ("b", bytearray(b""))], "path string, content binary")
    assert cut_records(df, "content").count() == 0


def test_optional_trim_and_cast(spark):
    df = spark.createDataFrame([(bytearray(b"  7x "),)], "rec binary")
    layout = Layout([("n", 1, 3), ("t", 4, 2)])
    sliced = slice_fields(df, layout)
    assert sliced.first()["n"] == "  7"
    out = cast_fields(trim_fields(sliced, layout), {"n": "int", "t": "int"}).first()
    assert (out["n"], out["t"]) == (7, None)
    assert sliced.select(F.length("t")).first()[0] == 2
