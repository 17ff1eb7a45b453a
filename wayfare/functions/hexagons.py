"""H3 cells of positions as columns, in DataFrame functions.

The globe is an icosahedron; a position is projected from the centre of the globe onto the plane
of the nearest face, rounded to the grid of the resolution, and followed up through the coarser
grids, each a seventh as dense and turned against the next. What is left at resolution 0 is a base
cell and how its grid is turned against the face's. Faces, base cells and turns are worked out
here from the shape of the icosahedron; the tables below are what is mere convention.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

# The published orientation of the icosahedron, by the centre of face 0 and the
# azimuth of its first axis (radians).
FACE_0 = (0.803582649718989942, 1.248397419617396099)
FACE_0_AZIMUTH = 5.619958268523939882

# The home of each base cell, in the order of their published numbers: the face and
# the steps along its three axes.
BASE_CELLS = """
1:100 2:110 1:000 2:100 0:200 1:110 1:001 2:000 0:100 2:010 1:010 1:011 3:100 3:110 11:200 4:100
0:000 6:010 0:001 2:011 7:001 2:001 0:110 6:001 10:200 6:000 3:000 11:100 4:110 3:010 0:011 4:000
5:010 0:010 7:010 11:110 7:000 10:100 12:200 6:101 7:101 4:001 3:001 3:011 4:010 6:100 11:000
8:001 5:001 14:200 5:000 12:100 10:110 4:011 12:110 7:100 11:010 10:000 13:200 10:001 11:001
9:010 8:010 6:200 8:000 9:001 14:100 5:101 16:011 8:101 5:100 12:000 7:200 12:010 10:010 9:000
13:100 16:001 15:011 15:010 16:010 14:110 13:110 5:200 8:100 14:000 9:101 14:001 17:001 12:001
16:000 17:011 15:001 16:101 9:100 15:000 13:000 8:200 13:010 17:101 19:010 14:010 19:011 17:010
13:001 17:000 16:100 9:200 15:101 15:100 18:011 18:001 19:001 17:100 19:000 18:010 18:101 19:200
19:100 18:000 19:101 18:100
""".split()

# A grid's direction digits, anticlockwise: each is one sixth of a turn beyond the one before.
TURN = "154623"
# Distance of neighbouring cells of resolution 0 in the plane of a face at distance 1.
UNIT = (3.0 - math.sqrt(5.0)) / 2
# Angle between the grids of odd and even resolutions.
TILT = math.asin(math.sqrt(3.0 / 28.0))
# Levels worked out in one generated method.
LEVELS_COMPILED = 4


def _dot(a, b):
    return sum(p * q for p, q in zip(a, b))


def _cross(a, b):
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def _mix(*terms):
    return tuple(sum(weight * vector[n] for weight, vector in terms) for n in range(3))


def _unit(a):
    return _mix((1 / math.sqrt(_dot(a, a)), a))


def _turned(vector, axis, angle):
    """``vector`` turned anticlockwise about ``axis``, seen from outside."""
    along = _dot(vector, axis) * (1 - math.cos(angle))
    return _mix((math.cos(angle), vector), (math.sin(angle), _cross(axis, vector)), (along, axis))


@lru_cache(1)
def faces() -> tuple:
    """Centre, first axis and second axis (a quarter turn anticlockwise) of each face."""
    lat, lon = FACE_0
    centre = (math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat))
    north = (-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat))
    east = (-math.sin(lon), math.cos(lon), 0.0)
    axis = _mix((math.cos(FACE_0_AZIMUTH), north), (math.sin(FACE_0_AZIMUTH), east))
    corners = [_unit(_mix((1, centre), (2 * UNIT, _turned(axis, centre, n * math.tau / 3))))
               for n in range(3)]
    top = corners[0]
    # The face beyond the edge opposite the top: mirror the top in the plane of that edge.
    normal = _unit(_cross(corners[1], corners[2]))
    below = _mix((1, top), (-2 * _dot(top, normal), normal))
    upper = [(_turned(centre, top, n * math.tau / 5), top) for n in range(5)]
    second = _unit(_mix((1, corners[1]), (1, corners[2]), (1, below)))
    middle = [(_turned(second, top, n * math.tau / 5), _turned(below, top, n * math.tau / 5))
              for n in range(5)]

    def antipodes(half):
        return [(_mix((-1, c)), _mix((-1, v))) for c, v in half[3:] + half[:3]]

    frames = []
    for centre, corner in upper + middle + antipodes(middle) + antipodes(upper):
        axis = _unit(_mix((1, corner), (-_dot(corner, centre), centre)))
        frames.append((centre, axis, _cross(centre, axis)))
    return tuple(frames)


def _point(face: int, a: float, b: float):
    """The point of the globe at ``a`` steps along the first grid axis and ``b`` along the second."""
    centre, first, second = faces()[face]
    return _unit(_mix((1, centre), (UNIT * (a - b / 2), first),
                      (UNIT * b * math.sqrt(3.0) / 2, second)))


def _steps(home: str) -> tuple[int, int, int]:
    face, (i, j, k) = home.split(":")[0], map(int, home.split(":")[1])
    return int(face), i - k, j - k


@lru_cache(1)
def centres() -> tuple:
    return tuple(_point(*_steps(home)) for home in BASE_CELLS)


def _angle(centre, start, end) -> float:
    """Anticlockwise angle at ``centre`` from the direction ``start`` to ``end``."""
    return math.atan2(_dot(centre, _cross(start, end)), _dot(start, end)
                      - _dot(start, centre) * _dot(end, centre))


def _pentagon_turns(rotations: int, clockwise: bool) -> str:
    """Sixths of a turn for each leading digit 0 to 6.

    A pentagon has no direction 1. A grid that has it takes it for the one before (a face that meets
    the pentagon along its second axis) or the one after, and rotations pass over it.
    """
    turns = []
    for leading in range(7):
        at, done = TURN.find(str(leading)), 0
        if leading:
            if leading == 1:
                done = -1 if clockwise else 1
            for _ in range(rotations):
                done += 1
                if TURN[(at + done) % 6] == "1":
                    done += 1
        turns.append(str(done % 6))
    return "".join(turns)


@lru_cache(1)
def base_table() -> dict[tuple[int, int, int], tuple[int, str]]:
    """(face, a, b) -> base cell and the sixths of a turn by leading digit.

    A face meets ten base cells, and six more that lie beyond its edges own cells within.
    """
    table = {}
    offsets = [(i - k, j - k) for i in range(3) for j in range(3) for k in range(3)
               if min(i, j, k) == 0 and (i + j + k < 3 or {i, j, k} == {0, 1, 2})]
    for face, (middle, _, _) in enumerate(faces()):
        for a, b in offsets:
            point = _point(face, a, b)
            cell = max(range(len(BASE_CELLS)), key=lambda n: _dot(centres()[n], point))
            home, home_a, home_b = _steps(BASE_CELLS[cell])
            centre = centres()[cell]
            if (home_a, home_b) == (2, 0):
                fifths = round(_angle(centre, faces()[home][0], middle) / (math.tau / 5))
                corner = {(2, 0): 0, (0, 2): 1, (-2, -2): 3}[a, b]
                turns = _pentagon_turns((fifths - corner) % 5, corner == 1)
            else:
                ahead = [_mix((1, _point(f, x + 0.01, y)), (-1, _point(f, x, y)))
                         for f, x, y in ((home, home_a, home_b), (face, a, b))]
                turns = str(round(_angle(centre, *ahead) / (math.tau / 6)) % 6) * 7
            table[face, a, b] = cell, turns
    return table


def lookup_table() -> list[str]:
    """For each (face, a + 2, b + 2): the base cell in octal and seven turns, or nothing."""
    table = base_table()
    return [format(table[key][0], "03o") + table[key][1] if key in table else ""
            for key in product(range(20), range(-2, 3), range(-2, 3))]


def with_hex_cell(df: DataFrame, name: str, lat: str, lon: str, resolution: int = 8) -> DataFrame:
    """``df`` with the H3 id (15 hexadecimal digits) of the cell that holds the position.

    Resolutions go from 0 to 15. The id is null for a null or non-finite position; latitudes beyond
    the poles and longitudes beyond 180 degrees are taken as angles. Each step is a projection of
    its own, so that what it needs twice is worked out once, in generated code.
    """
    if not 0 <= resolution <= 15:
        raise ValueError(f"resolution {resolution} is not from 0 to 15")
    mark = "_hex"
    while any(column.lower().startswith(mark) for column in df.columns):
        mark += "_"
    kept = [f"`{column}`" for column in df.columns if column.lower() != name.lower()]

    def c(short: str) -> Column:
        return F.col(f"{mark}_{short}")

    def step(frame: DataFrame, **columns: Column) -> DataFrame:
        return frame.withColumns({f"{mark}_{short}": value for short, value in columns.items()})

    def along(axis: int) -> Column:
        x, y, z = (F.element_at(
            F.expr(f"array({', '.join(f'{frame[axis][n]!r}D' for frame in faces())})"),
            c("face") + 1) for n in range(3))
        return F.coalesce((c("x") * x + c("y") * y + c("z") * z) / c("near"), F.lit(0.0))

    # Numbers stay doubles that are never null, which keeps the generated code short.
    lat, lon = F.col(lat), F.col(lon)
    known = F.coalesce((F.abs(lat) < float("inf")) & (F.abs(lon) < float("inf")), F.lit(False))
    kept_lat, kept_lon = (F.radians(F.coalesce(F.when(known, angle.cast("double")), F.lit(0.0)))
                          for angle in (lat, lon))
    df = step(df, known=known, lat=kept_lat, lon=kept_lon)
    df = step(df, x=F.cos(c("lat")) * F.cos(c("lon")), y=F.cos(c("lat")) * F.sin(c("lon")),
              z=F.sin(c("lat")))
    # Faces lie opposite each other: ten products tell the nearest of twenty.
    dots = [f"dot{n}" for n in range(10)]
    opposite = [15 + (n + 2) % 5 for n in range(5)] + [10 + (n + 2) % 5 for n in range(5)]
    df = step(df, **{dot: c("x") * centre[0] + c("y") * centre[1] + c("z") * centre[2]
                     for dot, (centre, _, _) in zip(dots, faces())})
    df = step(df, near=F.greatest(*(F.abs(c(dot)) for dot in dots)))
    face = F.lit(opposite[9])
    for n, dot in reversed(list(enumerate(dots))):
        face = F.when(c(dot) == c("near"), F.lit(n)).when(
            c(dot) == -c("near"), F.lit(opposite[n])).otherwise(face)
    df = step(df, face=face)
    df = step(df, u=along(1), v=along(2))

    # Places on the grid: along its first axis and, a third of a turn on, its second.
    tilt = TILT if resolution % 2 else 0.0
    scale = math.sqrt(7.0) ** resolution / UNIT
    df = step(df, u=c("u") * (scale * math.cos(tilt)) + c("v") * (scale * math.sin(tilt)),
              v=c("v") * (scale * math.cos(tilt)) - c("u") * (scale * math.sin(tilt)))
    df = step(df, p=c("u") + c("v") * (1 / math.sqrt(3.0)), q=c("v") * (2 / math.sqrt(3.0)))
    df = step(df, r=c("q") - c("p"))
    df = step(df, **{f"near_{axis}": F.rint(c(axis)) for axis in "pqr"})
    df = step(df, **{f"off_{axis}": F.abs(c(f"near_{axis}") - c(axis)) for axis in "pqr"})
    # The coordinate rounded by most is the one recomputed from the other two.
    by_p = (c("off_p") > c("off_q")) & (c("off_p") > c("off_r"))
    df = step(df, a=F.when(by_p, c("near_q") - c("near_r")).otherwise(c("near_p")),
              b=F.when(by_p | (c("off_q") <= c("off_r")), c("near_q")).otherwise(
                  c("near_p") + c("near_r")), path=F.lit(0.0))

    # Up one grid at a time: the parent's place, and the child's direction from its centre.
    a, b, up_a, up_b, seventh = c("a"), c("b"), c("up_a"), c("up_b"), F.lit(1 / 7)
    for level in range(resolution, 0, -1):
        if (resolution - level) % LEVELS_COMPILED == 0:
            # A function without generated code ends the stage's method, which would grow beyond
            # the 8000 bytes that the JVM compiles.
            df = step(df, path=F.element_at(F.transform(F.array(c("path")), lambda n: n), 1))
        if level % 2:
            df = step(df, up_a=F.rint((a * 3.0 - b) * seventh), up_b=F.rint((a + b * 2.0) * seventh))
            offsets = {"off_a": a - up_a * 2.0 - up_b, "off_b": b - up_b * 3.0 + up_a}
        else:
            df = step(df, up_a=F.rint((a * 2.0 + b) * seventh), up_b=F.rint((b * 3.0 - a) * seventh))
            offsets = {"off_a": a - up_a * 3.0 + up_b, "off_b": b - up_a - up_b * 2.0}
        df = step(df, a=up_a, b=up_b, **offsets)
        least = F.least(c("off_a"), c("off_b"), F.lit(0.0))
        # Seven times the least offset is taken off: 4, 2 and 1 for the three axes.
        digit = c("off_a") * 4.0 + c("off_b") * 2.0 - least * 7.0
        df = step(df, path=c("path") + digit * float(8 ** (resolution - level)))

    entries = F.split(F.lit(",".join(lookup_table())), ",")
    digits = F.lpad(F.conv(c("path").cast("long").cast("string"), 10, 8), resolution, "0")
    df = step(df, digits=digits if resolution else F.lit(""), entry=F.element_at(
        entries, ((c("face") * 5 + a + 2.0) * 5 + b + 3.0).cast("int")))
    leading = F.ltrim(c("digits"), F.lit("0")).substr(1, 1).try_cast("int")
    df = step(df, turn=c("entry").substr(F.coalesce(leading, F.lit(0)) + 4, F.lit(1)))
    turned = F.coalesce(*(
        F.when(c("turn") == str(n), F.translate(c("digits"), TURN, TURN[n:] + TURN[:n]))
        for n in range(6)))
    code = F.conv(F.concat(c("entry").substr(1, 3), turned, F.lit("7" * (15 - resolution))), 8, 16)
    return df.select(*kept, F.when(c("known"), F.concat(
        F.lit(f"8{resolution:x}"), F.lower(F.lpad(code, 13, "0")))).alias(name))
