"""Parsers on literal records, emitters, and binary geometry."""

import pytest
from pyspark.sql import functions as F

from wayfield.plans.text_queries import shapefile
from wayfield.sources import binary, emit, readers, text


def lines_of(spark, *records):
    return spark.createDataFrame([(r,) for r in records], "value string")


def parts(row):
    return [[[(v.x, v.y) for v in path] for path in part] for part in row.parts]


def stamp(df):
    """Timestamps as text, independent of the Python time zone."""
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


GEOJSON = ('{"key":136138,"value":{"geometry":{"coordinates":[116.44412,39.93984],"type":"Point"},'
           '"properties":{"oID":"2560","timestamp":"2008-02-02 20:12:32"},"type":"Feature"}}')


def test_geojson_in_an_envelope(spark):
    row = stamp(text.points(text.parse_geojson(lines_of(spark, GEOJSON)))).first()
    assert (row.obj_id, row.ts, row.x, row.y) == ("2560", "2008-02-02 20:12:32", 116.44412, 39.93984)


def test_geojson_forms(spark):
    feature = '{"geometry":{"coordinates":[1,2],"type":"Point"},"properties":{"oID":"\\"7\\"","timestamp":1201983152000}}'
    bare = '{"type":"Point","coordinates":[3,4]}'
    broken = '{"geometry":{"coordinates":[1,2],"type":"Point"},"properties":{"oID":"8","timestamp":"soon"}}'
    rows = stamp(text.parse_geojson(lines_of(spark, feature, bare, broken, "", "{nonsense"))).collect()
    assert [r.obj_id for r in rows] == ["7", None, "8", None, None]
    assert [r.ts for r in rows] == ["2008-02-02 20:12:32", None, None, None, None]
    assert [r.parts and parts(r) for r in rows] == [[[[(1, 2)]]], [[[(3, 4)]]], [[[(1, 2)]]], None, None]


def test_other_property_names(spark):
    rec = '{"geometry":{"coordinates":[1,2],"type":"Point"},"properties":{"id":"a","t":"02/02/2008"}}'
    row = text.parse_geojson(lines_of(spark, rec), oid="id", time="t", date_format="dd/MM/yyyy").withColumn(
        "ts", F.col("ts").cast("string")).first()
    assert (row.obj_id, row.ts) == ("a", "2008-02-02 00:00:00")


def test_rings_are_closed_and_shell_first(spark):
    rec = ('{"geometry":{"type":"Polygon","coordinates":[[[4,4],[6,4],[6,6],[4,6],[4,4]],'
           '[[0,0],[10,0],[10,10],[0,10]]]}}')
    got = parts(text.parse_geojson(lines_of(spark, rec)).first())
    assert got == [[[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]]]


def test_wkt_with_id_and_time(spark):
    row = stamp(text.parse_wkt(lines_of(spark, '"7, POLYGON((0 0, 4 0, 4 4, 0 4, 0 0)), 2008-02-02 20:12:32"'))).first()
    assert (row.obj_id, row.ts, row.geom_type) == ("7", "2008-02-02 20:12:32", "POLYGON")
    assert parts(row) == [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]]


@pytest.mark.parametrize("wkt,kind,want", [
    ("POINT(1 2)", "POINT", [[[(1, 2)]]]),
    ("point (1.5e1 -2)", "POINT", [[[(15, -2)]]]),
    ("POINT Z", None, None),
    ("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))", "MULTIPOLYGON",
     [[[(0, 0), (1, 0), (1, 1), (0, 0)]], [[(5, 5), (6, 5), (6, 6), (5, 5)]]]),
    ("MULTILINESTRING((0 0,1 1),(2 2,3 3))", "MULTILINESTRING", [[[(0, 0), (1, 1)], [(2, 2), (3, 3)]]]),
    ("MULTIPOINT((0 0),(1 1))", "MULTIPOINT", [[[(0, 0)], [(1, 1)]]]),
    ("MULTIPOINT(0 0, 1 1)", "MULTIPOINT", [[[(0, 0)], [(1, 1)]]]),
    ("LINESTRING(0 0 9, 1 1 9)", "LINESTRING", [[[(0, 0), (1, 1)]]]),
])
def test_wkt_kinds(spark, wkt, kind, want):
    row = text.parse_wkt(lines_of(spark, wkt)).first()
    assert row.geom_type == kind and (row.parts and parts(row)) == want


def test_wkt_collection(spark):
    rec = '"c1, GEOMETRYCOLLECTION(POINT(1 2), LINESTRING(0 0,1 1), MULTIPOLYGON(((0 0,1 0,1 1,0 0)))), 2008-02-02 20:12:32",'
    rows = stamp(text.parse_wkt_collection(lines_of(spark, rec))).orderBy("member").collect()
    assert [(r.obj_id, r.ts, r.geom_type) for r in rows] == [
        ("c1", "2008-02-02 20:12:32", k) for k in ("POINT", "LINESTRING", "MULTIPOLYGON")]
    assert parts(rows[1]) == [[[(0, 0), (1, 1)]]]


def test_csv_from_the_bridge(spark):
    row = text.parse_delimited(lines_of(spark, '"leader,603,3.43367037,46.33946579"')).withColumn(
        "ts", F.unix_millis("ts")).first()
    assert tuple(row) == ("leader", 603, 3.43367037, 46.33946579)


def test_csv_other_positions_and_bad_rows(spark):
    rows = text.parse_delimited(lines_of(spark, "1351039728980,9471001,-22366,2452", "x,,1", ""),
                                positions=(1, 0, 2, 3)).withColumn("ts", F.unix_millis("ts")).collect()
    assert tuple(rows[0]) == ("9471001", 1351039728980, -22366.0, 2452.0)
    assert tuple(rows[1]) == (None, None, 1.0, None) and tuple(rows[2]) == (None, None, None, None)


def test_csv_gap_is_zero(spark):
    df = spark.createDataFrame([("a", 5, 1.5, 2.5)], "obj_id string, ms long, x double, y double")
    df = df.withColumn("ts", F.timestamp_millis("ms"))
    assert emit.to_delimited(df, ",", (4, 0, 2, 1)).first().value == "5,2.5,1.5,0,a"
    assert emit.to_delimited(df, "\t").first().value == "a\t5\t1.5\t2.5"


def test_emit_leaves_out_what_is_missing(spark):
    df = emit.as_points(spark.createDataFrame([(None, None, 1.0, 2.0)], "obj_id string, ts timestamp, x double, y double"))
    assert emit.to_wkt(df).first().value == '"POINT(1.0 2.0)",'
    assert emit.to_geojson(df).first().value == '{"geometry":{"coordinates":[1.0,2.0],"type":"Point"},"type":"Feature"}'


def test_members_back_to_a_collection(spark):
    rec = '"c1, GEOMETRYCOLLECTION(POINT(1.0 2.0), LINESTRING(0.0 0.0, 1.0 1.0)), 2008-02-02 20:12:32",'
    rows = text.parse_wkt_collection(lines_of(spark, rec))
    assert emit.to_wkt_collection(emit.collect_members(rows)).first().value == rec


def test_sorted_text_file(spark, tmp_path):
    df = spark.range(2000).select(F.format_string("Second %05d: TRUE", F.lit(1999) - F.col("id")).alias("value"))
    emit.write_sorted_text(df, str(tmp_path / "out"), "value")
    files = sorted((tmp_path / "out").glob("part-*"))
    rows = [line for f in files for line in f.read_text().splitlines()]
    assert rows == sorted(rows) and len(rows) == 2000


PARCEL = ("0103000020E61000000100000005000000C081182C28780B4068436B9D732B4740803F61E91B770B4074FEB9DD6E2B4740"
          "80629C0F4C770B4010DE9EC4602B474000977541CD780B403C520AF8692B4740C081182C28780B4068436B9D732B4740")


def test_parcel(spark, tmp_path):
    (tmp_path / "parcels.csv").write_text(f"name,id,geom\n1 MONT,36,{PARCEL}\n")
    row = binary.read_parcels(spark, str(tmp_path / "parcels.csv")).first()
    assert (row.name, row.id, row.geom_type) == ("1 MONT", 36, "POLYGON")
    assert [(v.x, v.y) for v in row.rings[0]] == [
        (3.4336703724841016, 46.3394657872912), (3.4331587059786557, 46.339320865456926),
        (3.4332505435561984, 46.338890626499165), (3.4339852441797802, 46.33917141441313),
        (3.4336703724841016, 46.3394657872912)]


def test_multi_parcel(spark):
    one = bytes.fromhex(PARCEL)
    plain = b"\x01\x03\x00\x00\x00" + one[9:]
    multi = b"\x01\x06\x00\x00\x20" + one[5:9] + b"\x02\x00\x00\x00" + plain + plain
    df = spark.createDataFrame([("m", 1, multi.hex()), ("none", 2, None)], "name string, id int, geom string")
    rows = binary.parse_parcels(df).collect()
    assert rows[0].geom_type == "MULTIPOLYGON" and len(rows[0].rings) == 2 and rows[1].parts is None


def test_shapefile_folder(spark, tmp_path):
    import struct
    square = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]
    (tmp_path / "a.shp").write_bytes(shapefile([[square], [square, square]]))
    point = struct.pack("<idd", 1, 3.0, 4.0)
    line = struct.pack("<i4dii2i8d", 3, 0, 0, 3, 3, 2, 4, 0, 2, 0, 0, 1, 1, 2, 2, 3, 3)
    other = struct.pack("<i", 0)
    body = b"".join(struct.pack(">ii", i + 1, len(b) // 2) + b for i, b in enumerate((point, line, other)))
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + b"\0" * 72
    (tmp_path / "b.shp").write_bytes(head + body)
    (tmp_path / "b.dbf").write_bytes(b"not a shape")
    rows = binary.read_shapefiles(spark, str(tmp_path)).orderBy("path", "record").collect()
    assert [r.geom_type for r in rows] == ["POLYGON", "POLYGON", "POINT", "MULTILINESTRING"]
    assert len(rows[1].parts[0]) == 2 and parts(rows[2]) == [[[(3, 4)]]]
    assert parts(rows[3]) == [[[(0, 0), (1, 1)], [(2, 2), (3, 3)]]]


def test_kafka_options():
    assert readers.kafka_options("h:1", "t", "earliest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"}
    assert emit.kafka_options("h:1", "alarms") == {"kafka.bootstrap.servers": "h:1", "topic": "alarms"}


def _hex_wkb(code, *body, flags=0):
    import struct
    return (struct.pack("<BI", 1, code | flags) + b"".join(body)).hex()


def test_wkb_dimensions_and_kinds(spark):
    import struct

    def xy(*v):
        return struct.pack(f"<{len(v)}d", *v)

    def n(k):
        return struct.pack("<I", k)
    point = bytes.fromhex(_hex_wkb(1, xy(5, 6)))
    line = bytes.fromhex(_hex_wkb(2, n(2), xy(1, 2, 3, 4)))
    rows = [("z", _hex_wkb(2, n(2), xy(1, 2, 9, 3, 4, 9), flags=binary.Z_FLAG)),
            ("iso", _hex_wkb(3002, n(1), xy(1, 2, 8, 9))),
            ("points", _hex_wkb(4, n(2), point, point)), ("lines", _hex_wkb(5, n(2), line, line)),
            ("all", _hex_wkb(7, n(2), point, line)), ("empty", _hex_wkb(1, xy(float("nan"), float("nan")))),
            ("cut", _hex_wkb(2, n(9), xy(1, 2))), ("kind", _hex_wkb(99)), ("text", "zz")]
    df = spark.createDataFrame([(a, 1, g) for a, g in rows], "name string, id int, geom string")
    got = {r.name: r for r in binary.parse_parcels(df).collect()}
    assert parts(got["z"]) == [[[(1, 2), (3, 4)]]] and parts(got["iso"]) == [[[(1, 2)]]]
    assert got["points"].geom_type == "MULTIPOINT" and parts(got["points"]) == [[[(5, 6)], [(5, 6)]]]
    assert parts(got["lines"]) == [[[(1, 2), (3, 4)], [(1, 2), (3, 4)]]]
    assert parts(got["all"]) == [[[(5, 6)]], [[(1, 2), (3, 4)]]] and got["empty"].parts == []
    assert all(got[k].geom_type is None and got[k].parts is None for k in ("cut", "kind", "text"))


def test_wkt_tags_and_empty(spark):
    lines = ["7, POINT Z (1 2 3), 2008-02-02 20:12:32", "8, LINESTRING ZM (0 0 1 1, 2 2 1 1)", "9, POINT EMPTY",
             "nothing here", "POINT M(4 5 6)"]
    got = text.parse_wkt(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.obj_id for r in got] == ["7", "8", "9", None, None]
    assert [r.geom_type for r in got] == ["POINT", "LINESTRING", "POINT", None, "POINT"]
    assert parts(got[0]) == [[[(1, 2)]]] and parts(got[1]) == [[[(0, 0), (2, 2)]]] and parts(got[4]) == [[[(4, 5)]]]
    assert got[2].parts is None


def test_unreadable_shapefile_is_a_row(spark, tmp_path):
    square = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]
    good = shapefile([[square]])
    (tmp_path / "a.shp").write_bytes(good)
    (tmp_path / "b.shp").write_bytes(b"no shapes")
    rows = binary.read_shapefiles(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r.record, r.geom_type) for r in rows] == [(1, "POLYGON"), (None, None)]
