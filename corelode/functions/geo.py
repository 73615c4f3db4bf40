"""Points, boxes, cells and pixel bins.

Cells: an H3 binding is used when one is importable.  Otherwise a documented
equal-angle grid stands in for it; its cell numbers are **not** H3 cells.  Cells
of different resolutions do not nest in either, so every resolution is indexed
from the coordinates.
"""

from __future__ import annotations

import importlib.util
import math
import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PADDING = 0.30
WORLD_ALTITUDE = 10_000_000.0
HAS_H3 = importlib.util.find_spec("h3") is not None
# side of a grid cell in degrees at each resolution, close to the H3 cell of that number
GRID_DEGREES = {r: 180.0 / 2 ** (math.log2(7) / 2 * r + 2.2) for r in range(16)}


def decode_point(blob: bytes | None) -> tuple[float, float] | None:
    """(x, y) of a WKB or EWKB point in either byte order; None for all else."""
    if blob is None or len(blob) < 21:
        return None
    order = "<" if blob[0] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", blob, 1)
    at = 9 if kind & 0x20000000 else 5
    if kind & 0xFF != 1 or (kind & 0xFFFF) % 1000 != 1 or len(blob) < at + 16:
        return None
    x, y = struct.unpack_from(order + "dd", blob, at)
    return None if math.isnan(x) or math.isnan(y) else (x, y)


def encode_point(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, x, y)


def point_array(blobs: pa.Array) -> pa.StructArray:
    """:func:`decode_point` of a whole Arrow array; plain little-endian points are read at once."""
    blobs = blobs.cast(pa.large_binary())
    valid = blobs.is_valid().to_numpy(zero_copy_only=False)
    at = np.frombuffer(blobs.buffers()[1], dtype=np.int64)[blobs.offset : blobs.offset + len(blobs) + 1]
    data = np.frombuffer(blobs.buffers()[2] or b"", dtype=np.uint8)
    xy = np.full((len(blobs), 2), np.nan)
    plain = np.flatnonzero(valid & (np.diff(at) == 21))
    raw = data[at[plain][:, None] + np.arange(21)] if len(plain) else np.zeros((0, 21), np.uint8)
    ok = (raw[:, :5] == np.frombuffer(struct.pack("<BI", 1, 1), dtype=np.uint8)).all(axis=1)
    xy[plain[ok]] = np.ascontiguousarray(raw[ok, 5:]).view("<f8").reshape(-1, 2)
    odd = valid.copy()
    odd[plain[ok]] = False
    for r in np.flatnonzero(odd).tolist():
        xy[r] = decode_point(blobs[r].as_py()) or (np.nan, np.nan)
    none = np.isnan(xy).any(axis=1)
    return pa.StructArray.from_arrays([pa.array(xy[:, k], mask=none) for k in (0, 1)], ["x", "y"])


def point(col: Column) -> Column:
    """``struct<x double, y double>`` of WKB points (Arrow function); nulls where there is none."""

    def run(blobs: pa.Array) -> pa.Array:
        return point_array(blobs)

    return F.arrow_udf(run, "struct<x double, y double>")(col)


@dataclass(frozen=True)
class BBox:
    """A rectangle in degrees; ``west > east`` crosses the antimeridian."""

    south: float
    west: float
    north: float
    east: float

    @property
    def wraps(self) -> bool:
        return self.west > self.east

    @property
    def width(self) -> float:
        return self.east - self.west + (360 if self.wraps else 0)

    def padded(self, share: float = PADDING) -> BBox:
        """Grown by ``share`` on each side; latitudes are clamped, longitudes wrap."""
        dy, dx = (self.north - self.south) * share, self.width * share
        south, north = max(-90.0, self.south - dy), min(90.0, self.north + dy)
        if self.width + 2 * dx >= 360:
            return BBox(south, -180.0, north, 180.0)
        west, east = self.west - dx, self.east + dx
        return BBox(south, west + 360 if west < -180 else west, north, east - 360 if east > 180 else east)

    def where(self, lat: Column, lng: Column) -> Column:
        inside = lat.between(self.south, self.north)
        if self.width >= 360:
            return inside
        if self.wraps:
            return inside & (lng.between(self.west, 180.0) | lng.between(-180.0, self.east))
        return inside & lng.between(self.west, self.east)

    def is_world(self, slack: float = 2.0) -> bool:
        if self.wraps:
            return False
        return self.south <= -90 + slack and self.north >= 90 - slack and self.west <= -180 + slack and self.east >= 180 - slack


def is_global_view(altitude: float | None, box: BBox | None) -> bool:
    """Far away, no rectangle, or a rectangle that is the world."""
    return box is None or (altitude is not None and altitude > WORLD_ALTITUDE) or box.is_world()


def resolution_for(altitude: float) -> int:
    """Cell resolution for a camera height in metres."""
    return 4 if altitude > 3_000_000 else 6 if altitude > 300_000 else 8


def point_mode(altitude: float, was_points: bool) -> bool:
    """Points below 120 km, clusters above 180 km, no change between."""
    return True if altitude < 120_000 else False if altitude > 180_000 else was_points


def grid_cell(lat: Column, lng: Column, resolution: int) -> Column:
    """The equal-angle stand-in: 4 bits of resolution, 28 of row, 28 of column."""
    side = GRID_DEGREES[resolution]
    row = F.floor((lat + 90.0) / side).cast("long")
    col = F.floor((F.pmod(lng + 180.0, F.lit(360.0))) / side).cast("long")
    return F.lit(resolution << 56).cast("long") + F.shiftleft(row, 28) + col


def cell(lat: Column, lng: Column, resolution: int) -> Column:
    if HAS_H3:
        import h3

        def run(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([None if pd.isna(x) or pd.isna(y) else h3.str_to_int(h3.latlng_to_cell(x, y, resolution)) for x, y in zip(a, b)], dtype="Int64")

        return F.pandas_udf(run, "long")(lat, lng)
    return F.when(lat.isNotNull() & lng.isNotNull(), grid_cell(lat, lng, resolution))


def cell_hex(col: Column) -> Column:
    return F.lower(F.hex(col))


def valid_cell_hex(text: str) -> bool:
    """15 hexadecimal digits, as links carry them."""
    return len(text) == 15 and all(c in "0123456789abcdef" for c in text.lower())


def pixel_bins(lat: Column, lng: Column, box: BBox, size: int = 512) -> tuple[Column, Column]:
    """(x, y) of the raster bin of a point, clamped to the raster; wrapped longitudes are unrolled."""
    shifted = F.when(lng < box.west, lng + 360.0).otherwise(lng) if box.wraps else lng
    one = lambda v: F.least(F.lit(size - 1), F.greatest(F.lit(0), F.floor(v).cast("int")))
    return one((shifted - box.west) / max(1e-9, box.width) * size), one((F.lit(box.north) - lat) / max(1e-9, box.north - box.south) * size)


def heatmap_radius(cells: int, size: int = 512) -> int:
    """Blur radius in pixels: twice the spacing of the cells, from 6 to 30."""
    return max(6, min(30, round(2 * math.sqrt(size * size / max(1, cells)))))
