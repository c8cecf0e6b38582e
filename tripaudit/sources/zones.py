"""Zone archives: the attribute table and the polygons of a zipped shapefile (SRC-12, PRJ-9).

``load_zones`` reads landed archives as one table of zones, which a borough filter and
``mark_zone_table`` turn into the zone flag.  Archives come through Spark's binary file
reader, so they may lie on any file system; a task parses one archive, a few hundred zones.

Nothing is made up for a bad archive: one that is no archive, lacks a part, is cut short, has
fewer shapes than attribute rows or no id column fails the read, with the file's name.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = "LocationID int, zone string, borough string, rings array<array<struct<x:double,y:double>>>"
# Magic number, versions and polygon kinds (plain, with z, with m) of the format.
SHAPE_FILE, POLYGONS, NO_SHAPE = 9994, (5, 15, 25), 0


class BadArchive(ValueError):
    """An archive that is not a whole zone file."""


def attribute_rows(data: bytes) -> Iterator[dict[str, str] | None]:
    """Rows of a dBase table as texts by lower-cased column name; None for deleted ones."""
    if len(data) < 33:
        raise BadArchive("attribute table is cut short")
    n, start, width = struct.unpack_from("<IHH", data, 4)
    columns, at = [], 32
    while at < min(start, len(data)) and data[at] != 0x0D:
        columns.append((data[at:at + 11].split(b"\0")[0].decode("ascii").lower(), data[at + 16]))
        at += 32
    if width != 1 + sum(w for _, w in columns) or len(data) < start + n * width:
        raise BadArchive("attribute table is cut short")
    for i in range(n):
        row, at, out = data[start + i * width:start + (i + 1) * width], 1, {}
        for name, w in columns:
            out[name] = row[at:at + w].decode("utf-8", "replace").strip(" \0")
            at += w
        yield None if row[:1] == b"*" else out


def polygons(data: bytes) -> Iterator[list[list[tuple[float, float]]]]:
    """The rings of every shape; an empty list for a shape without geometry."""
    if len(data) < 100 or struct.unpack_from(">i", data)[0] != SHAPE_FILE:
        raise BadArchive("no shape file")
    end, at = struct.unpack_from(">i", data, 24)[0] * 2, 100
    if end > len(data):
        raise BadArchive("shapes are cut short")
    while at < end:
        try:
            size = struct.unpack_from(">i", data, at + 4)[0] * 2
            body = data[at + 8:at + 8 + size]
            kind, = struct.unpack_from("<i", body)
            at += 8 + size
            if kind == NO_SHAPE:
                yield []
                continue
            if kind not in POLYGONS:
                raise BadArchive(f"shape of kind {kind} is no polygon")
            parts, points = struct.unpack_from("<ii", body, 36)
            starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
            flat = struct.unpack_from(f"<{2 * points}d", body, 44 + 4 * parts)
        except struct.error as exc:
            raise BadArchive("shapes are cut short") from exc
        xy = list(zip(flat[::2], flat[1::2], strict=True))
        yield [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]


def parse_archive(content: bytes, id_column: str = "LocationID") -> list[dict]:
    """The zones of one archive."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            found = {n.rsplit(".", 1)[-1].lower(): z.read(n) for n in z.namelist()
                     if not n.rsplit("/", 1)[-1].startswith(".")}
    except (zipfile.BadZipFile, EOFError) as exc:
        raise BadArchive(f"no archive: {exc}") from exc
    if missing := {"dbf", "shp"} - set(found):
        raise BadArchive(f"archive without {', '.join(sorted(missing))}")
    rows, shapes = list(attribute_rows(found["dbf"])), list(polygons(found["shp"]))
    if len(rows) != len(shapes):
        raise BadArchive(f"{len(rows)} attribute rows and {len(shapes)} shapes")
    out = []
    for row, rings in zip(rows, shapes, strict=True):
        if row is None:
            continue
        try:
            out.append({"LocationID": int(float(row[id_column.lower()])), "zone": row.get("zone"),
                        "borough": row.get("borough"), "rings": rings})
        except (KeyError, ValueError) as exc:
            raise BadArchive(f"zone without a number in {id_column}") from exc
    return out


def load_zones(spark: SparkSession, path: str, id_column: str = "LocationID") -> DataFrame:
    """Zones of all landed archives under ``path``: ``LocationID, zone, borough, rings``."""
    schema = pa.schema([("LocationID", pa.int32()), ("zone", pa.string()), ("borough", pa.string()),
                        ("rings", pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))])

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    zones = parse_archive(content.as_py(), id_column)
                except BadArchive as exc:
                    raise BadArchive(f"{name}: {exc}") from exc
                for z in zones:
                    z["rings"] = [[{"x": x, "y": y} for x, y in ring] for ring in z["rings"]]
                yield from pa.Table.from_pylist(zones, schema).to_batches()

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, ZONES)


def zones_of(zones: DataFrame, *boroughs: str) -> DataFrame:
    """Zones of the named boroughs, whatever their letters' case."""
    return zones.filter(F.lower("borough").isin([b.lower() for b in boroughs]))
