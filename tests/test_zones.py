"""Zone archives: read back what a small writer made, fail on anything else."""

import io
import os
import struct
import zipfile

import pytest
from helpers import trips_df

from tripaudit.operators import mark_zone, mark_zone_table
from tripaudit.sources.zones import BadArchive, load_zones, parse_archive, zones_of

ZONES = [(4, "Alphabet City", "Manhattan"), (12, "Battery Park", "Manhattan"), (7, "Astoria", "Queens"), (300, "Île", "manhattan")]
SQUARE = [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]]
HOLED = SQUARE + [[(0.2, 0.2), (0.3, 0.2), (0.2, 0.2)]]


def dbf(rows, names=("LocationID", "zone", "borough"), deleted=()):
    widths = [10, 20, 20]
    head = b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w]) + bytes(15) for n, w in zip(names, widths))
    size = 1 + sum(widths)
    body = b"".join((b"*" if i in deleted else b" ") + b"".join(str(v).encode().ljust(w) for v, w in zip(r, widths))
                    for i, r in enumerate(rows))
    return struct.pack("<BBBBIHH20x", 3, 24, 1, 1, len(rows), 32 + len(head) + 1, size) + head + b"\r" + body + b"\x1a"


def shp(shapes, kind=5):
    records = b""
    for i, rings in enumerate(shapes, 1):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
            content = (struct.pack("<i4dii", kind, 0, 0, 1, 1, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts)
                       + b"".join(struct.pack("<dd", *p) for p in points))
        records += struct.pack(">ii", i, len(content) // 2) + content
    return struct.pack(">i20xi", 9994, (100 + len(records)) // 2) + struct.pack("<ii", 1000, kind) + bytes(64) + records


def archive(path, **parts):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for ext, data in parts.items():
            z.writestr(f"taxi_zones/taxi_zones.{ext}", data)
    if path:
        with open(path, "wb") as f:
            f.write(buf.getvalue())
    return buf.getvalue()


def good(path=None):
    return archive(path, dbf=dbf(ZONES), shp=shp([SQUARE, HOLED, None, SQUARE]), prj=b"x")


def test_zones_feed_the_flag(spark, tmp_dir):
    good(os.path.join(tmp_dir, "taxi_zones.zip"))
    zones = load_zones(spark, tmp_dir)
    got = {r.LocationID: r for r in zones.collect()}
    assert {(r.LocationID, r.zone, r.borough) for r in got.values()} == set(ZONES)
    assert [[(p.x, p.y) for p in ring] for ring in got[12].rings] == HOLED and got[7].rings == []
    trips = trips_df(spark, [{"dropoff_loc": x} for x in (4, 7, 12, 300, 5, None)])
    chosen = zones_of(zones, "MANHATTAN")
    by_file = {r.dropoff_loc: r.inside_zone for r in mark_zone_table(trips, chosen).collect()}
    by_list = {r.dropoff_loc: r.inside_zone for r in mark_zone(trips, [4, 12, 300]).collect()}
    assert by_file == by_list == {4: True, 7: False, 12: True, 300: True, 5: False, None: None}


def test_command_line_takes_the_zone_from_an_archive(spark, tmp_dir, capsys):
    import json

    from test_store import land

    from tripaudit.__main__ import main

    good(os.path.join(tmp_dir, "taxi_zones.zip"))
    land(os.path.join(tmp_dir, "raw"), "yellow", 1, 30)  # drop-offs 4, 12 and 300 in turn
    for i, (boroughs, trips) in enumerate(((["Manhattan"], 24), (["Queens"], 0))):
        out = os.path.join(tmp_dir, f"out{i}")
        assert main(["audit", "--raw", os.path.join(tmp_dir, "raw"), "--out", out, "--quiet", "--fleets", "yellow",
                     "--zones", os.path.join(tmp_dir, "taxi_zones.zip"), "--boroughs", *boroughs]) == 0
        path = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["reports"]["surcharge_compliance"]
        rows = spark.read.option("header", True).csv(path).collect()
        assert sum(int(r.total_zone_trips) for r in rows) == trips


def test_several_archives_and_deleted_rows(spark, tmp_dir):
    good(os.path.join(tmp_dir, "a.zip"))
    archive(os.path.join(tmp_dir, "b.zip"), dbf=dbf([(1, "EWR", "EWR"), (2, "x", "y")], deleted={1}), shp=shp([SQUARE, SQUARE], 15))
    assert sorted(r.LocationID for r in load_zones(spark, os.path.join(tmp_dir, "*.zip")).collect()) == [1, 4, 7, 12, 300]


BAD = {
    "no archive": b"<html>not found</html>",
    "an empty file's content": b"",
    "without shp": archive(None, dbf=dbf(ZONES)),
    "without dbf": archive(None, shp=shp([SQUARE] * 4)),
    "table cut": archive(None, dbf=dbf(ZONES)[:-60], shp=shp([SQUARE] * 4)),
    "table header only": archive(None, dbf=b"abc", shp=shp([SQUARE] * 4)),
    "shapes cut": archive(None, dbf=dbf(ZONES), shp=shp([SQUARE] * 4)[:-30]),
    "no shape file": archive(None, dbf=dbf(ZONES), shp=b"x" * 200),
    "points": archive(None, dbf=dbf(ZONES), shp=shp([SQUARE] * 4, kind=1)),
    "fewer shapes": archive(None, dbf=dbf(ZONES), shp=shp([SQUARE] * 3)),
    "no id": archive(None, dbf=dbf(ZONES, names=("id", "zone", "borough")), shp=shp([SQUARE] * 4)),
    "id no number": archive(None, dbf=dbf([("x", "a", "b")]), shp=shp([SQUARE])),
    "archive cut": good()[:-40],
}


@pytest.mark.parametrize("how", BAD)
def test_a_bad_archive_fails(how):
    with pytest.raises(BadArchive):
        parse_archive(BAD[how])


def test_a_bad_archive_names_its_file(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "cut_zones.zip"), "wb") as f:
        f.write(BAD["shapes cut"])
    with pytest.raises(Exception, match="cut_zones.zip: shapes are cut short"):
        load_zones(spark, tmp_dir).collect()
