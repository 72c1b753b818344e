"""Column expressions on 3D boxes.

A box is a struct of six doubles, a point a struct of x, y, z, and a geometry
an array of points.  All functions stay inside generated code; none needs a
geometry type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW = ("xmin", "ymin", "zmin")
HIGH = ("xmax", "ymax", "zmax")
SIDES = LOW + HIGH
BOX_TYPE = "struct<" + ",".join(f"{s}:double" for s in SIDES) + ">"
POINT_TYPE = "struct<x:double,y:double,z:double>"

#: The placement that changes nothing.
IDENTITY = (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def point(x, y, z) -> Column:
    """A point from three numbers; null unless all are given."""
    parts = [_column(v).cast("double") for v in (x, y, z)]
    made = F.struct(*[p.alias(n) for p, n in zip(parts, "xyz")])
    return F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), made)


def _box(sides: list[Column]) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip(sides, SIDES)])


def box_of_point(p: Column | str) -> Column:
    p = _column(p)
    return F.when(p.isNotNull(), _box([p["x"], p["y"], p["z"]] * 2))


def box_of_points(points: Column | str) -> Column:
    """Extent of a geometry column; null for no geometry and for no points."""
    points = _column(points)
    axes = [points[axis] for axis in "xyz"]
    box = _box([F.array_min(a) for a in axes] + [F.array_max(a) for a in axes])
    return F.when(F.size(points) > 0, box)


def extent_agg(x, y, z) -> Column:
    """Aggregate: extent of vertices; null when there is no vertex."""
    axes = [_column(v).cast("double") for v in (x, y, z)]
    box = _box([F.min(a) for a in axes] + [F.max(a) for a in axes])
    return F.when(F.min(axes[0]).isNotNull(), box)


def merge_agg(box: Column | str) -> Column:
    """Aggregate: one box around many; nulls count for nothing."""
    box = _column(box)
    merged = _box([F.min(box[s]) for s in LOW] + [F.max(box[s]) for s in HIGH])
    return F.when(F.min(box["xmin"]).isNotNull(), merged)


def merge_box(a: Column | str, b: Column | str) -> Column:
    """One box around two; null only when both are null."""
    a, b = _column(a), _column(b)
    merged = _box([F.least(a[s], b[s]) for s in LOW] + [F.greatest(a[s], b[s]) for s in HIGH])
    return F.when(a.isNotNull() | b.isNotNull(), merged)


def _corners(box: Column, every: bool) -> list[tuple[Column, Column, Column]]:
    x, y, z = [(box[lo], box[hi]) for lo, hi in zip(LOW, HIGH)]
    if every:
        return [(a, b, c) for a in x for b in y for c in z]
    return [(x[0], y[0], z[0]), (x[1], y[0], z[0]), (x[1], y[1], z[1]), (x[0], y[1], z[1])]


def ring(box: Column | str) -> Column:
    """The closed five-point ring that stands for a box: two corners at the
    lower height, two at the upper."""
    box = _column(box)
    points = [
        F.struct(x.alias("x"), y.alias("y"), z.alias("z")) for x, y, z in _corners(box, every=False)
    ]
    return F.when(box.isNotNull(), F.array(*points, points[0]))


def ring_srid(srid: Column | str | None, default: int) -> Column:
    """Reference system of a ring: 0 and null stand for the database default."""
    if srid is None:
        return F.lit(default)
    return F.coalesce(F.nullif(_column(srid), F.lit(0)), F.lit(default))


def matrix(text: Column | str) -> Column:
    """Numbers of a placement, row by row; null text is the identity.

    Fewer than 12 numbers are an error, as is text that is not a number.
    """
    text = _column(text)
    parts = F.split(F.trim(text), " +")
    numbers = F.transform(parts, lambda v: v.try_cast("double"))
    found = F.size(F.filter(numbers, lambda v: v.isNotNull())).cast("string")
    problem = F.concat(
        F.lit("a placement needs at least 12 numbers and nothing else, but has "),
        found, F.lit(" among "), F.size(parts).cast("string"), F.lit(" parts: "), text,
    )
    wrong = (F.size(parts) < 12) | F.exists(numbers, lambda v: v.isNull())
    checked = F.when(wrong, F.raise_error(problem)).otherwise(numbers)
    return F.when(text.isNull(), F.array(*[F.lit(float(v)) for v in IDENTITY])).otherwise(checked)


def place(
    box: Column | str, numbers: Column | str, ref: Column | str | None = None, corners: int = 4
) -> Column:
    """Box of a placed template.

    ``numbers`` is an array from :func:`matrix`, ``ref`` a point added to the
    translation.  The four ring corners are moved by default, as the ring is
    what stands for the box; ``corners=8`` moves the full box instead.
    """
    if corners not in (4, 8):
        raise ValueError("corners must be 4 or 8")
    box, numbers = _column(box), _column(numbers)
    moved = []
    for row, axis in zip((0, 4, 8), "xyz"):
        shift = numbers[row + 3]
        if ref is not None:
            shift = shift + F.coalesce(_column(ref)[axis], F.lit(0.0))
        moved.append(
            F.array(
                *[
                    numbers[row] * x + numbers[row + 1] * y + numbers[row + 2] * z + shift
                    for x, y, z in _corners(box, corners == 8)
                ]
            )
        )
    placed = _box([F.array_min(m) for m in moved] + [F.array_max(m) for m in moved])
    return F.when(box.isNotNull(), placed)


def sides(box: str = "box") -> list[Column]:
    """The six numbers of a box column as plain columns."""
    return [F.col(box)[s].alias(s) for s in SIDES]
