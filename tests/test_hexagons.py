"""H3 cells: published ids, whole covers of the globe, pentagons, poles and the antimeridian."""

import pytest
from pyspark.sql import functions as F

from wayfare.functions.hexagons import BASE_CELLS, UNIT, base_table, centres, with_hex_cell

POINT = "latitude double, longitude double"


def cells(spark, points, resolution):
    df = spark.createDataFrame(points, POINT)
    named = with_hex_cell(df, "cell", "latitude", "longitude", resolution)
    return [row["cell"] for row in named.collect()]


# Ids published with the documentation of H3 and of systems that use it.
PUBLISHED = [
    (37.3615593, -122.0553238, 5, "85283473fffffff"),
    (37.3615593, -122.0553238, 7, "87283472bffffff"),
    (37.7752702151959, -122.418307270836, 9, "8928308280fffff"),
    (40.689167, -74.044444, 10, "8a2a1072b59ffff"),
    (55.71290588, 37.79506683, 15, "8f11aa6a38826f6"),
    (0.0, 0.0, 0, "8075fffffffffff"),
]


@pytest.mark.parametrize("lat, lon, resolution, cell", PUBLISHED)
def test_published_ids(spark, lat, lon, resolution, cell):
    assert cells(spark, [(lat, lon)], resolution) == [cell]


def test_base_cells_are_numbered_from_north_to_south():
    heights = [point[2] for point in centres()]
    assert len(heights) == 122
    assert all(a >= b - 1e-9 for a, b in zip(heights, heights[1:]))
    pentagons = [n for n, home in enumerate(BASE_CELLS) if home.endswith("200")]
    assert pentagons == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
    assert {cell for cell, _ in base_table().values()} == set(range(122))
    # Rotations published for face 0.
    assert base_table()[0, -1, -1][0] == 18 and base_table()[0, 0, -1] == (5, "5" * 7)
    assert base_table()[0, 2, 1] == (15, "1" * 7) and base_table()[0, 1, 2] == (41, "1" * 7)


def spread(df, resolution):
    """Widest extent of a cell along an axis through the globe, as a share of its radius."""
    lat, lon = F.radians("latitude"), F.radians("longitude")
    axes = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    named = with_hex_cell(df.withColumns(axes), "cell", "latitude", "longitude", resolution)
    per_cell = named.groupBy("cell").agg(*((F.max(a) - F.min(a)).alias(a) for a in axes))
    return per_cell.agg(F.count("*"), F.max(F.greatest(*axes))).first()


def width(resolution):
    """From corner to corner in the plane of a face, which the globe only makes shorter."""
    return 2 * UNIT / 3 ** 0.5 / 7 ** (resolution / 2)


def test_cells_cover_the_globe_once(spark):
    """As many cells as there are, and none in two places: every face's turns agree."""
    points = spark.range(300_000).select(
        F.degrees(F.asin(F.rand(1) * 2 - 1)).alias("latitude"),
        (F.rand(2) * 360 - 180).alias("longitude"))
    for resolution in (0, 1, 2):
        count, widest = spread(points, resolution)
        assert count == 2 + 120 * 7 ** resolution
        assert widest < width(resolution)


def test_cells_around_pentagons_are_compact(spark):
    pentagons = spark.createDataFrame(
        [centres()[n] for n, home in enumerate(BASE_CELLS) if home.endswith("200")],
        "px double, py double, pz double")
    for resolution, reach in ((3, 0.11), (4, 0.04)):
        near = pentagons.join(spark.range(5_000)).select(*(
            (F.col("p" + axis) + (F.rand(n) * 2 - 1) * reach).alias(axis)
            for n, axis in enumerate("xyz"))).select(
            F.degrees(F.atan2("z", F.hypot("x", "y"))).alias("latitude"),
            F.degrees(F.atan2("y", "x")).alias("longitude"))
        assert spread(near, resolution)[1] < width(resolution)


def test_poles_antimeridian_and_missing_positions(spark):
    assert len(set(cells(spark, [(90.0, lon) for lon in (-180.0, -7.5, 0.0, 45.0, 179.0)], 8))) == 1
    assert len(set(cells(spark, [(-90.0, lon) for lon in (-180.0, -7.5, 0.0, 45.0)], 8))) == 1
    east, west, beyond = cells(spark, [(33.5, 179.9999999), (33.5, -179.9999999), (33.5, 180.0000001)], 8)
    assert east == west == beyond
    nan, inf = float("nan"), float("inf")
    assert cells(spark, [(None, 1.0), (1.0, None), (nan, 1.0), (1.0, nan), (inf, 1.0), (1.0, -inf)],
                 8) == [None] * 6
    with pytest.raises(ValueError):
        with_hex_cell(spark.createDataFrame([], POINT), "cell", "latitude", "longitude", 16)


def test_ids_have_fifteen_digits_and_begin_with_the_base_cell(spark):
    points = [(33.5731, -7.5898), (-33.9, 151.2), (2.3, -5.2), (64.7, 10.5)]
    coarse, fine = cells(spark, points, 0), cells(spark, points, 15)
    assert all(len(cell) == 15 for cell in coarse + fine)
    assert [cell[2:4] for cell in coarse[2:]] == ["75", "09"]


def test_cells_need_no_python_no_shuffle_and_keep_other_columns(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1, "old")], POINT + ", _hex_a int, cell string")
    named = with_hex_cell(df, "cell", "latitude", "longitude", 0)
    assert named.columns == ["latitude", "longitude", "_hex_a", "cell"]
    assert tuple(named.first()) == (0.0, 0.0, 1, "8075fffffffffff")
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    empty = spark.createDataFrame([], POINT)
    assert with_hex_cell(empty, "cell", "latitude", "longitude").count() == 0
