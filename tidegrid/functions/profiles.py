"""Names of the values of sensor vectors, by the sensor's profile and layout."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: package names that data carries, and the sizes of their vectors
CAPACITIVE_PACKAGE, FORCE_PACKAGE, IMAGE_PACKAGE = "tashan_tactile", "paxini_tactile", "dmtac_tactile"
CAPACITIVE_DIM, FORCE_DIM = 25, 234
# fixed values: segments of a packed frame, version 1: height, width, channels, bytes of an item
PACKED_V1 = {"raw_image": (240, 320, 1, 1), "deformation2d": (240, 320, 2, 4), "normal": (240, 320, 1, 4), "shear": (240, 320, 2, 4), "depth": (240, 320, 1, 4)}
# fixed values: segments of version 2, whose sizes are free
PACKED_V2 = ("raw_image", "infer_image", "deformation2d", "depth", "shear", "distributed_force", "contact_area", "wrench")


@dataclass(frozen=True)
class Group:
    """Values of one kind: their usual number, and the layout keys that give it and their place.

    Without a place a group follows the one before.
    """

    name: str
    size: int
    start: int | None = None

    @property
    def size_key(self) -> str:
        return f"{self.name}_len"

    @property
    def start_key(self) -> str:
        return f"{self.name}_start"


@dataclass(frozen=True)
class Profile:
    """What a sensor's store must look like, and how its vector's values are named.

    ``mark`` is a layout key that only this profile has.  Where ``whole``, groups that do not add up to the
    vector name nothing.
    """

    name: str
    package: str
    dim: int | None
    dtype: str
    mark: str = ""
    groups: tuple[Group, ...] = ()
    whole: bool = False


# fixed values: the profiles, and their groups in the order of the vector
_ALL = [
    Profile("tashan", CAPACITIVE_PACKAGE, CAPACITIVE_DIM, "float32", "cap_len", (Group("cap", 16), Group("nf", 2), Group("tf", 2), Group("tf_dir", 2), Group("s_prox", 2), Group("m_prox", 1)), whole=True),
    Profile("paxini", FORCE_PACKAGE, FORCE_DIM, "uint8", "force_raw_start", (Group("force_raw", 3, 0), Group("distribution_raw", 231, 3))),
    Profile("dmtac", IMAGE_PACKAGE, None, "uint8"),
]
PROFILES = {p.package: p for p in _ALL}


_DIGITS = re.compile(r"\s*[+-]?[0-9]+\s*")


def layout_numbers(layout: dict | None) -> dict[str, int]:
    """A layout's entries that are numbers or text of digits, as whole numbers; others are as good as absent."""
    found = {}
    for key, value in (layout or {}).items():
        if isinstance(value, str) and _DIGITS.fullmatch(value):
            found[key] = int(value)
        elif isinstance(value, (int, float)) and math.isfinite(value):
            found[key] = math.trunc(value)
    return found


def plain_names(dim: int) -> list[str]:
    return [f"value_{i:03d}" for i in range(dim)]


def profile_of(dim: int, package: str | None = None, name: str | None = None, layout: dict | None = None) -> Profile | None:
    """The first profile with groups that the package, the name, a layout key or the size tells."""
    told = lambda p: p.package == package or p.name == name or p.mark in (layout or {}) or p.dim == dim
    return next((p for p in _ALL if p.groups and told(p)), None)


def value_names(dim: int, package: str | None = None, profile: str | None = None, layout: dict | None = None) -> list[str]:
    """Column names for a vector of ``dim`` values: those of its profile's groups, plain ones elsewhere.

    A group's usual size holds for vectors of the profile's size; others have what their layout says.
    """
    found, told = profile_of(dim, package, profile, layout), layout_numbers(layout)
    places: dict[int, str] = {}
    free = 0
    for group in found.groups if found else ():
        size = max(0, told.get(group.size_key, group.size if dim == found.dim else 0))
        start = free if group.start is None else told.get(group.start_key, group.start)
        if start >= 0:
            places |= {start + i: f"{group.name}_{i:03d}" for i in range(size)}
            free = start + size
    if found and found.whole and len(places) != dim:
        places = {}
    return [places.get(i, plain) for i, plain in enumerate(plain_names(dim))]


def segments(shapes: dict[str, tuple[int, int, int, int]]) -> list[dict]:
    """Start and length of each segment of a packed frame, in order."""
    out, at = [], 0
    for name, (height, width, channels, size) in shapes.items():
        length = height * width * channels * size
        out.append({"segment": name, "start": at, "length": length, "height": height, "width": width, "channels": channels, "itemsize": size})
        at += length
    return out


def placed_segments(df: DataFrame, by: list[str], order: list[str], shape: list[str]) -> DataFrame:
    """Each segment's ``length``, the product of its shape, and ``start``, where the one before it in the frame ends.

    ``by`` names a frame.  A null in a shape makes a length of null, which holds no room.
    """
    length = reduce(lambda a, b: a * b, [F.col(n).cast("long") for n in shape])
    before = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("length", length).withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)))
