import datetime as dt
import glob
import io
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rangeloom.functions.types import struct_of
from rangeloom.sources import dump, dump_codec
from rangeloom.sources.dump_codec import SIGNATURE, DumpError, RowCodec, decode_stream, wrap

EIGHT = struct_of([
    ("i", "Int64"), ("j", "Int32"), ("d", "Float64"), ("f", "Float32"), ("s", "Utf8"),
    ("b", "Boolean"), ("t", "Timestamp(Nanosecond, None)"), ("on", "Date32"),
])
TWO = struct_of([("id", "Int64"), ("text", "Utf8")])

TIMES = st.datetimes(dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31))
ROWS = st.lists(
    st.tuples(
        *[
            st.none() | values
            for values in (
                st.integers(-(2**63), 2**63 - 1),
                st.integers(-(2**31), 2**31 - 1),
                st.floats(allow_nan=False),
                st.floats(width=32, allow_nan=False),
                st.text(),
                st.booleans(),
                TIMES,
                TIMES.map(lambda t: t.date()),
            )
        ]
    ),
    max_size=30,
)


def batch_of(schema, rows):
    codec = RowCodec(schema)
    columns = zip(*rows) if rows else [[]] * len(schema)
    arrays = [pa.array(list(c), k) for c, k in zip(columns, codec.arrow_types)]
    return pa.RecordBatch.from_arrays(arrays, schema=codec.arrow_schema)


def dump_of(schema, rows):
    return wrap(RowCodec(schema).encode(batch_of(schema, rows)))


def decoded(schema, data, safe=False, piece=None):
    source = io.BytesIO(data)
    read = (lambda n: source.read(min(n, piece))) if piece else source.read
    batches = list(decode_stream(read, RowCodec(schema, safe)))
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


@given(ROWS)
@settings(max_examples=150, deadline=None)
def test_roundtrip(rows):
    assert decoded(EIGHT, dump_of(EIGHT, rows)) == rows
    assert decoded(EIGHT, dump_of(EIGHT, rows), safe=True) == rows


@given(ROWS, st.integers(19, 200))
@settings(max_examples=60, deadline=None)
def test_roundtrip_in_small_pieces(rows, piece):
    assert decoded(EIGHT, dump_of(EIGHT, rows), piece=piece) == rows


def test_known_bytes():
    """Written out by hand, so that encoder and decoder cannot share an error."""
    field = lambda fmt, value: struct.pack(">i" + fmt, struct.calcsize(">" + fmt), value)
    row = struct.pack(">h", 8) + b"".join([
        field("q", -5), field("i", 7), field("d", 0.5), field("f", 1.5),
        struct.pack(">i", 5) + "né\n!".encode(), b"\x00\x00\x00\x01\x02",
        field("q", 86_400_000_001), field("i", -1),
    ])
    nulls = struct.pack(">h", 8) + b"\xff\xff\xff\xff" * 8
    data = SIGNATURE + struct.pack(">II", 0, 3) + b"ext" + row + nulls + b"\xff\xff"
    expected = (-5, 7, 0.5, 1.5, "né\n!", True, dt.datetime(2000, 1, 2, 0, 0, 0, 1), dt.date(1999, 12, 31))
    assert decoded(EIGHT, data) == [expected, (None,) * 8]


def test_values_that_look_like_rows():
    """Row marks inside fixed-width values, and single-column rows."""
    look = int.from_bytes(struct.pack(">hhi", 2, 0, 8)[:8], "big")
    rows = [(look, "x" * (i % 3)) for i in range(200)] + [(0x0002_0000_0008_0002, None)] * 50
    assert decoded(TWO, dump_of(TWO, rows)) == rows
    one = struct_of([("n", "Int32")])
    rows = [(65536 + 4,), (1,), (None,), (0x0001_0000,)] * 40
    assert decoded(one, dump_of(one, rows)) == rows


GOOD = [(1, "one"), (2, "two"), (3, "three")]


def damaged():
    good = dump_of(TWO, GOOD)
    yield "wrong signature", b"X" + good[1:]
    yield "wrong signature", b""
    yield "cut in a row", good[:-5]
    yield "no trailer", good[:-2]
    yield "bytes after the trailer", good + b"!"
    yield "row of 3 columns, expected 2", good[:-2] + struct.pack(">h", 3) + b"\xff\xff\xff\xff" * 3 + b"\xff\xff"
    yield "column 'id': field of 4 bytes", wrap(struct.pack(">hii", 2, 4, 9) + b"\xff\xff\xff\xff")
    yield "column 'text': field of -7 bytes", wrap(struct.pack(">hii", 2, -1, -7))
    yield "column 'text': invalid UTF-8", good.replace(b"two", b"t\xffo")
    yield "cut in the header", SIGNATURE + struct.pack(">II", 0, 9) + b"ext"


DAMAGED = list(damaged())


@pytest.mark.parametrize("message, data", DAMAGED)
def test_damage(message, data):
    with pytest.raises(DumpError, match=message):
        decoded(TWO, data)


def test_safe_decode_keeps_the_row():
    good = dump_of(TWO, GOOD)
    assert decoded(TWO, good.replace(b"two", b"t\xffo"), safe=True) == [(1, "one"), (2, None), (3, "three")]
    short = struct.pack(">hii", 2, 4, 9) + struct.pack(">i", 1) + b"z"
    assert decoded(TWO, wrap(short), safe=True) == [(None, "z")]


def test_infinite_times():
    schema = struct_of([("t", "Timestamp(Nanosecond, None)"), ("d", "Date32")])
    rows = [struct.pack(">hiqii", 2, 8, t, 4, d) for t, d in ((2**63 - 1, -(2**31)), (-(2**63), 2**31 - 1), (0, 0))]
    data = wrap(b"".join(rows))
    with pytest.raises(DumpError, match="column 't': infinite"):
        decoded(schema, data)
    assert decoded(schema, data, safe=True) == [(None, None)] * 2 + [
        (dt.datetime(2000, 1, 1), dt.date(2000, 1, 1))
    ]


FAKE = struct.pack(">hiq", 2, 8, 0x4142434445464748) + struct.pack(">i", 1) + b"z"
SPLIT_ROWS = st.lists(
    st.tuples(
        st.integers(0, 2**63 - 1),
        st.none() | st.text(max_size=40) | st.integers(1, 40).map(lambda n: (FAKE * n).decode()) | st.integers(0, 900).map(lambda n: "x" * n),
    ),
    max_size=60,
)


@given(SPLIT_ROWS, st.integers(1, 900), st.integers(8, 300), st.integers(8, 200), st.booleans())
@settings(max_examples=300, deadline=None)
def test_exits_are_exact(rows, split, window, walk, safe):
    """Whatever texts look like, the chain over the maps is the chain of rows."""
    codec = RowCodec(TWO, safe)
    data = dump_of(TWO, rows)
    begins, at = [], 19
    for row in rows:
        begins.append(at)
        at += len(codec.encode(batch_of(TWO, [row])))
    begins.append(at)  # the trailer
    before = dump.WINDOW_BYTES, dump.WALK_BYTES
    dump.WINDOW_BYTES, dump.WALK_BYTES = window, walk
    try:
        place = 0
        for begin in range(0, len(data), split):
            end = min(begin + split, len(data))
            if place is None or place >= end:
                continue
            known = dict(zip(*dump._exits(io.BytesIO(data), codec, begin, end, len(data))))
            if place not in known and place >= begin + window:
                known = dict(zip(*dump._exits(io.BytesIO(data), codec, begin, end, len(data), place)))
            place = known.get(place)
            assert place == next((b for b in begins if b >= end), None)
    finally:
        dump.WINDOW_BYTES, dump.WALK_BYTES = before


@pytest.fixture(scope="module")
def dumps(spark, table, tmp_path_factory):
    """Documents in two dump files, one much the larger, and their rows."""
    folder = str(tmp_path_factory.mktemp("dumps"))
    docs = table("documents").select("doc_id", "text")
    dump.write_dumps(docs.coalesce(1), folder + "/large", TWO)
    dump.write_dumps(docs.limit(3).coalesce(1), folder + "/small", TWO)
    return folder, docs.unionAll(docs.limit(3))


@pytest.mark.parametrize("split_bytes", [None, 1 << 16, 300_000, 1 << 30])
def test_files(spark, dumps, split_bytes):
    folder, rows = dumps
    found = dump.decode_files(spark, folder + "/*", TWO, split_bytes=split_bytes)
    assert found.exceptAll(rows).count() == 0 and rows.exceptAll(found).count() == 0


def test_splits_share_a_large_file(spark, dumps):
    folder, _ = dumps
    splits = dump.dump_splits(dump.dump_files(spark, folder + "/large"), TWO, split_bytes=1 << 18)
    spans = sorted((r.start, r.stop) for r in splits.collect())
    assert len(spans) > 3 and spans[0][0] == 0 and spans[-1][1] is None
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_file_status_and_failure(spark, tmp_path):
    on_disk = [(message, data) for message, data in DAMAGED if data]
    for i, (_, data) in enumerate(on_disk):
        (tmp_path / f"{i:02d}.bin").write_bytes(data)
    (tmp_path / "99.bin").write_bytes(dump_of(TWO, GOOD))
    lines = sorted(dump.file_status(spark, str(tmp_path), TWO).collect())
    assert len(lines) == len(on_disk) + 1
    for line, (message, _) in zip(lines, on_disk):
        assert message in line.error
    assert (lines[-1].rows, lines[-1].error) == (3, None)
    with pytest.raises(Exception, match="00.bin"):
        dump.decode_files(spark, str(tmp_path / "00.bin"), TWO, split_bytes=None).collect()


@pytest.fixture(scope="module")
def deceptive(tmp_path_factory):
    """A dump with a text of three megabytes that reads as rows, so that splits go wrong."""
    fake = struct.pack(">hiq", 2, 8, 0x4142434445464748) + struct.pack(">i", 1) + b"z"
    rows = [(i, "plain") for i in range(100)]
    rows.insert(50, (50, (fake * (3_000_000 // len(fake))).decode()))
    path = tmp_path_factory.mktemp("deceptive") / "dump.bin"
    path.write_bytes(dump_of(TWO, rows))
    return str(path), rows


@pytest.mark.parametrize("mode", ["strict", "safe"])
@pytest.mark.parametrize("split_bytes", [None, 1 << 16, 1 << 20])
def test_deceptive_text_reads_right(spark, deceptive, split_bytes, mode):
    path, rows = deceptive
    found = dump.decode_files(spark, path, TWO, mode, split_bytes)
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    line = dump.file_status(spark, path, TWO, mode, split_bytes=split_bytes or 1 << 18).first()
    assert (line.rows, line.error) == (101, None)


def test_damaged_files_in_small_splits(spark, tmp_path):
    rows = [(i, "row " * (i % 40)) for i in range(500)]
    good = dump_of(TWO, rows)
    for name, data in {"cut": good[:-700], "hole": good[:9000] + b"\x00" * 50 + good[9050:], "short": good[:-2], "long": good + b"xx"}.items():
        (tmp_path / name).write_bytes(data)
    status = {r.path.rsplit("/", 1)[1]: r for r in dump.file_status(spark, str(tmp_path), TWO, split_bytes=2000).collect()}
    assert sorted(status) == ["cut", "hole", "long", "short"] and all(r.error for r in status.values())
    assert "cut in a row" in status["cut"].error and "no trailer" in status["short"].error


def test_heal_files(spark, dumps, deceptive, tmp_path):
    folder, docs = dumps
    for i, (_, data) in enumerate(DAMAGED):
        if data:
            (tmp_path / f"bad-{i}.bin").write_bytes(data)
    (tmp_path / "deceptive.bin").write_bytes(open(deceptive[0], "rb").read())
    (tmp_path / "large.bin").write_bytes(open(glob.glob(folder + "/large/*.bin")[0], "rb").read())
    expected = dump.dump_files(spark, str(tmp_path)).selectExpr("path", "7L AS expected_rows")
    rows, report = dump.heal_files(spark, str(tmp_path), TWO, expected, split_bytes=1 << 20)
    n_bad = sum(bool(data) for _, data in DAMAGED)
    assert report.count() == n_bad and report.where("error IS NULL").count() == 0
    n_docs = docs.count() - 3
    assert rows.count() == 7 * n_bad + 101 + n_docs
    assert rows.where("id IS NULL").count() == 7 * n_bad


@pytest.mark.parametrize("limit", [dump.BROADCAST_PATHS, 0])
def test_heal_dumps(spark, monkeypatch, limit):
    monkeypatch.setattr(dump, "BROADCAST_PATHS", limit)
    blobs = [("ok", dump_of(TWO, GOOD)), ("cut", dump_of(TWO, GOOD)[:-5]), ("text", DAMAGED[8][1])]
    df = spark.createDataFrame(blobs, "path string, content binary")
    expected = spark.createDataFrame([("ok", 3), ("cut", 5), ("text", 2)], "path string, expected_rows bigint")
    rows, report = dump.heal_blobs(df, TWO, expected)
    found = [tuple(r) for r in rows.collect()]
    assert sorted(r for r in found if r[0]) == GOOD
    assert found.count((None, None)) == 7
    assert sorted((r.path, r.expected_rows) for r in report.collect()) == [("cut", 5), ("text", 2)]


def test_a_split_that_misses_its_end_is_an_error(spark, dumps):
    folder, _ = dumps
    path = dump.dump_files(spark, folder + "/large").first().path
    wrong = spark.createDataFrame([(path, 0, 1 << 16)], "path string, start bigint, stop bigint")
    with pytest.raises(Exception, match="bytes 0 to 65536"):
        dump._decode_spans(wrong, TWO, "strict").collect()


@pytest.mark.parametrize("size", [dump_codec.LONG_SPAN - 1, dump_codec.LONG_SPAN * 50])
def test_long_and_short_texts(size):
    rows = [(i, None if i % 5 == 0 else "é" * (i % size)) for i in range(400)]
    assert decoded(TWO, dump_of(TWO, rows)) == rows


def test_safe_blobs(spark):
    df = spark.createDataFrame([("text", DAMAGED[8][1])], "path string, content binary")
    assert sorted(map(tuple, dump.decode_blobs(df, TWO, "safe").collect())) == [(1, "one"), (2, None), (3, "three")]
    with pytest.raises(Exception, match="text: column 'text': invalid UTF-8"):
        dump.decode_blobs(df, TWO).collect()


def test_a_small_run_reads_no_more_than_itself():
    """A buffer of eight megabytes would be filled for every one of the splits."""
    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            Counting.taken += len(data)
            return data

    rows = [(i, "text") for i in range(50_000)]
    source = pa.PythonFile(Counting(dump_of(TWO, rows)), "r")
    read = dump._reader(source, 19, 19 + 1000)
    assert len(read(5000)) == 1000 and Counting.taken <= 2000


def test_many_small_splits_share_tasks(spark):
    files = spark.createDataFrame([("one", 4 << 30), ("two", 10)], "path string, length bigint")
    assert dump.count_tasks(files, 1 << 16) <= max(4 * spark.sparkContext.defaultParallelism, 130)
    assert dump.count_tasks(files, 1 << 30) == 5


def test_a_split_sends_on_its_exits_only():
    """Thousands of rows leave a split at one place; walked from those places, the chain is whole."""
    codec = RowCodec(TWO)
    rows = [(i, None if i % 5 == 0 else "x" * (i % 9)) for i in range(20_000)]
    data, split = dump_of(TWO, rows), 1 << 16
    cuts = [(b, min(b + split, len(data))) for b in range(0, len(data), split)]
    places = {0}
    for begin, end in cuts:
        found = np.unique(dump._exits(io.BytesIO(data), codec, begin, end, len(data))[1])
        assert len(found) <= 3
        places.update(found.tolist())
    at = 0
    for begin, end in cuts:
        entries = [p for p in places if begin <= p < end]
        known = dict(zip(*dump._exits(io.BytesIO(data), codec, begin, end, len(data), entries)))
        at = known.get(at)
    assert at is None or at == len(data) - 2


def test_rows_longer_than_the_window(spark, tmp_path):
    """Splits that rows enter beyond the window, or not at all."""
    rows = [(i, "x" * n) for i, n in enumerate([5, 3_000_000, 10, 1_400_000, 0, 2_000_000, 1_300_000, 7, 4_000_000, 1, 1_500_000, 3] * 2)]
    (tmp_path / "long.bin").write_bytes(dump_of(TWO, rows))
    (tmp_path / "short.bin").write_bytes(dump_of(TWO, GOOD))
    for split_bytes in (1_300_000, 2_500_000):
        found = dump.decode_files(spark, str(tmp_path), TWO, split_bytes=split_bytes)
        assert sorted(map(tuple, found.collect())) == sorted([*rows, *GOOD])
