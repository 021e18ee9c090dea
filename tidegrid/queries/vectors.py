"""Vector statistics and poses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.columns import vector_problem, wide
from ..functions.profiles import value_names
from ..operators import statistics
from .tables import quaternions, table


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Arrays as rounded columns ``name_0`` and so on, seven of each."""
    return df.select("vec_id", *[F.round(F.get(n, F.lit(i)).cast("double"), 3).alias(f"{n}_{i}") for n in names for i in range(7)])


def vector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics.vector_stats(table(spark, sf_dir, "embeddings"), ["embedding"])
    return out.select("column", F.col("dim").cast("long").alias("dim"), *[F.round(n, 5).alias(n) for n in ("mean", "std", "min", "max")], "count")


def vector_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    broken = F.when(F.col("vec_id") % 10 == 0, F.slice("embedding", 1, 60)).when(F.col("vec_id") % 10 == 1, F.transform("embedding", lambda v: F.when(v > 0, float("nan")).otherwise(v))).when(F.col("vec_id") % 10 != 2, F.col("embedding").cast("array<double>"))
    return e.groupBy(F.coalesce(vector_problem(broken, 64), F.lit("ok")).alias("problem")).agg(F.count("*").alias("n"))


def vector_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 25).alias("v"))
    return e.select("vec_id", *[F.round(x.cast("double"), 5).alias(n) for x, n in zip(wide(F.col("v"), value_names(25)), value_names(25), strict=True)])


def vector_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "embeddings").select("vec_id", statistics.vector_summary(F.col("embedding")).alias("s"))
    return s.select("vec_id", "s.size", *[F.round(f"s.{n}", 5).alias(n) for n in ("min", "max", "mean")], F.round(F.get("s.first", F.lit(7)), 5).alias("eighth"))


def allclose_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"), F.reverse("embedding").alias("b"))
    out = statistics.greatest_difference(e, "vec_id", "a", "b")
    return out.select(F.round("max_diff", 5).alias("max_diff"), F.col("key").alias("vec_id"), F.col("dim").cast("long").alias("dim"), (F.col("max_diff") <= 1e-6).alias("close"))


def mean_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(statistics.mean_absolute_error(F.col("embedding"), F.reverse("embedding")), 5).alias("mae"))


def quat_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quaternions(spark, sf_dir).select("vec_id", g.normalized(F.slice("p", 4, 4)).alias("q"))
    return q.select("vec_id", *[F.round(F.get("q", F.lit(i)), 5).alias(f"q{i}") for i in range(4)])


def pose_state7(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quaternions(spark, sf_dir)
    return _rounded(q.select("vec_id", g.state7(F.col("p"), F.lit(0.04)).alias("state")), "state")


def rel_action7(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quaternions(spark, sf_dir)
    return _rounded(q.select("vec_id", g.relative_action7(F.col("p"), F.col("q"), F.lit(0.02)).alias("action")), "action")


def pose_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far applying a relative action misses the pose it came from: nothing, to rounding."""
    q = quaternions(spark, sf_dir).select("vec_id", "p", "q", g.relative_action7(F.col("p"), F.col("q"), F.lit(0.0)).alias("a"))
    back = q.select("vec_id", g.apply_action7(F.col("a"), F.col("q")).alias("back"), F.concat(g.as_float(F.slice("p", 1, 3)), g.as_float(g.normalized(F.slice("p", 4, 4)))).alias("p"))
    moved = g.norm(F.zip_with(F.slice("back", 1, 3), F.slice("p", 1, 3), lambda a, b: a - b))
    dot = F.aggregate(F.zip_with(F.slice("back", 4, 4), F.slice("p", 4, 4), lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    return back.select("vec_id", (moved < 1e-4).alias("same_place"), (1 - F.abs(dot) < 1e-5).alias("same_turn"))


def local_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quaternions(spark, sf_dir)
    d = q.select("vec_id", g.local_delta(F.col("q"), F.col("p")).alias("d"))
    return d.select("vec_id", *[F.round(F.get("d", F.lit(i)), 4).alias(f"d{i}") for i in range(6)])


def change_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quaternions(spark, sf_dir).select("vec_id", F.slice("p", 1, 3).alias("v"))
    return q.select("vec_id", *[F.round(F.get(g.matrix_times(g.HEADSET_AXES, F.col("v")), F.lit(i)), 5).alias(f"v{i}") for i in range(3)])


def dead_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quaternions(spark, sf_dir).select("vec_id", F.slice("p", 1, 3).alias("v"))
    z = q.select("vec_id", g.dead_zone(F.col("v"), 0.2).alias("z"), g.at_boundary(F.col("v"), [-0.2] * 3, [0.2] * 3).alias("bounded"))
    return z.select("vec_id", *[F.round(F.get("z", F.lit(i)), 5).alias(f"z{i}") for i in range(3)], "bounded")


_P = "SELECT vec_id, embedding[1:7]::DOUBLE[] AS p, embedding[8:14]::DOUBLE[] AS q FROM embeddings"


def _unit(name: str, out: str) -> str:
    return ", ".join(f"{name}[{i}] / sqrt({' + '.join(f'{name}[{j}] * {name}[{j}]' for j in range(4, 8))}) AS {out}{k}" for i, k in zip(range(4, 8), "xyzw", strict=True))


def _vector(x: str, y: str, z: str, w: str) -> str:
    """Columns r0 .. r2 of the rotation vector."""
    scale = f"CASE WHEN {w} < 0 THEN -1 ELSE 1 END * CASE WHEN a <= 1e-3 THEN 2 + a * a / 12 ELSE a / sin(a / 2) END"
    return ", ".join(f"{v} * {scale} AS r{i}" for i, v in enumerate((x, y, z)))


def _angle(x: str, y: str, z: str, w: str) -> str:
    return f"2 * atan2(sqrt({x} * {x} + {y} * {y} + {z} * {z}), abs({w})) AS a"


# t * conjugate(u): the turn from u to t in world axes; and conjugate(u) * t, in u's own axes
_WORLD = "-tw * ux + tx * uw - ty * uz + tz * uy AS x, -tw * uy + tx * uz + ty * uw - tz * ux AS y, -tw * uz - tx * uy + ty * ux + tz * uw AS z, tw * uw + tx * ux + ty * uy + tz * uz AS w"
_LOCAL = "uw * tx - ux * tw - uy * tz + uz * ty AS x, uw * ty + ux * tz - uy * tw - uz * tx AS y, uw * tz - ux * ty + uy * tx - uz * tw AS z, uw * tw + ux * tx + uy * ty + uz * tz AS w"
# the step in the earlier pose's axes: the transposed matrix of u
_STEP = """(1 - 2 * (uy * uy + uz * uz)) * dx + 2 * (ux * uy + uz * uw) * dy + 2 * (ux * uz - uy * uw) * dz AS s0,
    2 * (ux * uy - uz * uw) * dx + (1 - 2 * (ux * ux + uz * uz)) * dy + 2 * (uy * uz + ux * uw) * dz AS s1,
    2 * (ux * uz + uy * uw) * dx + 2 * (uy * uz - ux * uw) * dy + (1 - 2 * (ux * ux + uy * uy)) * dz AS s2"""

QUERIES = {
    "vector_stats": (
        vector_stats,
        """SELECT 'embedding' AS "column", i - 1 AS dim, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std, round(min(v), 5) AS min, round(max(v), 5) AS max, count(*) AS count
        FROM (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i""",
    ),
    "vector_validity": (
        vector_validity,
        """SELECT problem, count(*) AS n FROM (SELECT CASE WHEN vec_id % 10 = 0 THEN 'size' WHEN vec_id % 10 = 1 AND list_max(embedding) > 0 THEN 'not_finite' WHEN vec_id % 10 = 2 THEN 'missing' ELSE 'ok' END AS problem FROM embeddings) GROUP BY problem""",
    ),
    "vector_wide": (vector_wide, "SELECT vec_id, " + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 5) AS {n}" for i, n in enumerate(value_names(25))) + " FROM embeddings"),
    "vector_summary": (
        vector_summary,
        "SELECT vec_id, len(embedding) AS size, round(list_min(embedding)::DOUBLE, 5) AS min, round(list_max(embedding)::DOUBLE, 5) AS max, round(list_avg(embedding::DOUBLE[]), 5) AS mean, round(embedding[8]::DOUBLE, 5) AS eighth FROM embeddings",
    ),
    "allclose_argmax": (
        allclose_argmax,
        """SELECT round(d, 5) AS max_diff, vec_id, dim, d <= 1e-6 AS close FROM (SELECT vec_id, i - 1 AS dim, abs(a::DOUBLE - b::DOUBLE) AS d FROM (SELECT vec_id, unnest(embedding) AS a, unnest(list_reverse(embedding)) AS b, generate_subscripts(embedding, 1) AS i FROM embeddings)) ORDER BY d DESC, vec_id, dim LIMIT 1""",
    ),
    "mean_difference": (
        mean_difference,
        "SELECT vec_id, round(avg(abs(a::DOUBLE - b::DOUBLE)), 5) AS mae FROM (SELECT vec_id, unnest(embedding) AS a, unnest(list_reverse(embedding)) AS b FROM embeddings) GROUP BY vec_id",
    ),
    "quat_normalize": (quat_normalize, f"SELECT vec_id, round(ux, 5) AS q0, round(uy, 5) AS q1, round(uz, 5) AS q2, round(uw, 5) AS q3 FROM (SELECT vec_id, {_unit('p', 'u')} FROM ({_P}))"),
    "pose_state7": (
        pose_state7,
        f"""WITH u AS (SELECT vec_id, p, {_unit("p", "u")} FROM ({_P})), a AS (SELECT *, {_angle("ux", "uy", "uz", "uw")} FROM u), r AS (SELECT *, {_vector("ux", "uy", "uz", "uw")} FROM a)
        SELECT vec_id, round(p[1], 3) AS state_0, round(p[2], 3) AS state_1, round(p[3], 3) AS state_2, round(r0, 3) AS state_3, round(r1, 3) AS state_4, round(r2, 3) AS state_5, 0.04::DOUBLE AS state_6 FROM r""",
    ),
    "rel_action7": (
        rel_action7,
        f"""WITH u AS (SELECT vec_id, p, q, {_unit("p", "t")}, {_unit("q", "u")} FROM ({_P})), m AS (SELECT vec_id, p, q, {_WORLD} FROM u), a AS (SELECT *, {_angle("x", "y", "z", "w")} FROM m), r AS (SELECT *, {_vector("x", "y", "z", "w")} FROM a)
        SELECT vec_id, {", ".join(f"round(p[{i + 1}] - q[{i + 1}], 3) AS action_{i}" for i in range(3))}, {", ".join(f"round(r{i}, 3) AS action_{i + 3}" for i in range(3))}, 0.02::DOUBLE AS action_6 FROM r""",
    ),
    "pose_roundtrip": (pose_roundtrip, "SELECT vec_id, true AS same_place, true AS same_turn FROM embeddings"),
    "local_delta": (
        local_delta,
        f"""WITH u AS (SELECT vec_id, p[1] - q[1] AS dx, p[2] - q[2] AS dy, p[3] - q[3] AS dz, {_unit("p", "t")}, {_unit("q", "u")} FROM ({_P})), m AS (SELECT vec_id, {_STEP}, {_LOCAL} FROM u),
        a AS (SELECT *, {_angle("x", "y", "z", "w")} FROM m), r AS (SELECT *, {_vector("x", "y", "z", "w")} FROM a)
        SELECT vec_id, {", ".join(f"round(s{i}, 4) AS d{i}" for i in range(3))}, {", ".join(f"round(r{i}, 4) AS d{i + 3}" for i in range(3))} FROM r""",
    ),
    "change_axes": (change_axes, f"SELECT vec_id, round(-p[3], 5) AS v0, round(-p[1], 5) AS v1, round(p[2], 5) AS v2 FROM ({_P})"),
    "dead_zone": (
        dead_zone,
        f"""SELECT vec_id, {", ".join(f"CASE WHEN s < 0.2 THEN 0.0 ELSE round(p[{i + 1}], 5) END AS z{i}" for i in range(3))}, {" OR ".join(f"p[{i}] <= -0.2 + 1e-8 OR p[{i}] >= 0.2 - 1e-8" for i in (1, 2, 3))} AS bounded
        FROM (SELECT *, sqrt(p[1] * p[1] + p[2] * p[2] + p[3] * p[3]) AS s FROM ({_P}))""",
    ),
}
