"""Embedding near-deduplication: spherical k-means cells, blocked cosines, one row kept per group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lodestone.llm.components import components
from lodestone.llm.simhash import merge
from lodestone.session import discard, durable

#: Cells are fitted on about this many vectors of a label.
SAMPLE = 4_096
#: Vectors that a cell should hold, and the most cells of one label.
CELL = 4_096
MOST_CELLS = 64
STEPS = 10
#: Vectors of one side of a comparison block.
PIECE = 2_048


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so squares stay finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spherical_kmeans(points: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres: every point joins the centre of largest cosine, which turns to the sum of its points."""
    # Each further start is the point that lies farthest from the starts so far.
    starts, nearest = [0], points @ points[0]
    while len(starts) < min(cells, len(points)):
        starts.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, points @ points[starts[-1]])
    centres = points[starts]
    for _ in range(STEPS):
        home = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, points)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-300), centres)
    return centres


def cells_of(points: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of every point, and a mask of all cells that must hold a copy of it.

    If y lies within the chord d of x, and y is at home in cell b rather than x's home a,
    then x is nearer to a than to b by at most d |a - b|. So a copy of x in each such cell
    b makes sure that every y meets all its neighbours in y's own home cell.
    """
    dots = points @ centres.T
    home = dots.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    chord = np.sqrt(2 - 2 * cosine)
    best = dots[np.arange(len(points)), home][:, None]
    return home, best - dots <= chord * apart + 1e-9


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Two rows of equal, non-null label link if their cosine in double precision is at least
    ``cosine``. Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without vec_id, link with nothing; vectors of different length don't link.
    Equal vectors of a label are compared once and counted as often as they occur; rows that
    repeat a vec_id with other vectors keep their own links, and may share a component. Every
    linked pair is found: a vector is copied to all cells whose members could be within
    reach. Cells are compared in blocks of bounded size, whatever a label or cell holds.
    An empty table gives no rows; other columns are ignored.
    """
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = values.isNotNull() & ~bad & F.exists(values, lambda x: x != 0)
    every = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), values.alias("x"), usable.alias("usable"))
    rows = every.where("usable and vec_id is not null and label is not null").select(
        "vec_id",
        F.concat_ws(":", F.size("x").cast("string"), "label").alias("label"),
        "x",
        F.xxhash64("x").alias("d1"),
        F.xxhash64(F.lit(1), "x").alias("d2"),
    )
    same = ["label", "d1", "d2"]
    # A group of equal vectors has a number of its own: a vec_id may be repeated with other vectors.
    groups = rows.groupBy(*same).agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    groups = durable(groups.withColumn("rep", F.monotonically_increasing_id()), "vectors-groups")
    member = durable(rows.select("vec_id", *same).join(groups, same).select("vec_id", "rep", "copies"), "vectors-members")
    reps = rows.join(groups, same).where("vec_id = first").dropDuplicates(["rep"])
    reps = durable(reps.select("rep", "copies", "label", "x"), "vectors-distinct")

    sizes = reps.groupBy("label").agg(F.count("*").alias("n"))
    tagged = reps.join(sizes, "label")
    share = F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 30)) < F.ceil(F.lit(float(SAMPLE << 30)) / F.col("n"))

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        points = unit(np.stack(sample.sort_values("rep")["x"].to_numpy()))
        cells = int(min(MOST_CELLS, -(-sample["n"].iloc[0] // CELL)))
        return pd.DataFrame({"label": sample["label"].iloc[0], "centre": list(spherical_kmeans(points, cells))})

    fitted = tagged.where(share).select("label", "rep", "x", "n").groupBy("label").applyInPandas(fit, "label string, centre array<double>")
    centres = durable(fitted, "vectors-centres")

    pieces = F.ceil(F.col("n") / PIECE).cast("int")
    dealt = tagged.select("rep", "copies", "label", "x", F.pmod(F.xxhash64("rep", F.lit(1)), pieces).cast("int").alias("part"))
    spread = centres.join(sizes, "label").select("label", "centre", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("part"))

    def assign(points: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(points):
            return pd.DataFrame({"label": [], "cell": [], "home": [], "rep": [], "copies": [], "x": []})
        x = unit(np.stack(points["x"].to_numpy()))
        # A label that the sample missed is one cell.
        c = np.stack(centres["centre"].to_numpy()) if len(centres) else x[:1]
        home, copied = cells_of(x, c, cosine)
        row, cell = np.nonzero(copied)
        return pd.DataFrame(
            {"label": points["label"].iloc[0], "cell": cell, "home": cell == home[row], "rep": points["rep"].to_numpy()[row], "copies": points["copies"].to_numpy()[row], "x": list(x[row])}
        )

    assigned = dealt.groupBy("label", "part").cogroup(spread.groupBy("label", "part")).applyInPandas(
        assign, "label string, cell int, home boolean, rep long, copies long, x array<double>"
    )
    assigned = durable(assigned, "vectors-cells")
    held = assigned.groupBy("label", "cell").agg(
        F.ceil(F.count("*") / PIECE).cast("int").alias("parts"), F.ceil(F.count_if("home") / PIECE).cast("int").alias("homes")
    )
    placed = durable(assigned.join(held.where("homes > 0"), ["label", "cell"]), "vectors-placed")
    discard(assigned)

    def side(name: str, own: str, other: str) -> DataFrame:
        # Read anew for each side, so that Spark can tell their columns apart.
        placed = vectors.sparkSession.read.schema(layout).parquet(path)
        number = F.pmod(F.xxhash64("rep", F.lit(2)), F.col(own)).cast("int")
        return placed.where("home" if name == "asked" else "true").select(
            "rep", "copies", "x", "label", "cell",
            (number if name == "asked" else F.explode(F.sequence(F.lit(0), F.col(other) - 1))).alias("i"),
            (number if name != "asked" else F.explode(F.sequence(F.lit(0), F.col(other) - 1))).alias("j"),
        )

    keys = ["label", "cell", "i", "j"]

    def compare(asked: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(others):
            return pd.DataFrame({"u": [], "v": [], "n": []})
        a, b = asked["rep"].to_numpy(), others["rep"].to_numpy()
        near = (np.stack(asked["x"].to_numpy()) @ np.stack(others["x"].to_numpy()).T >= cosine) & (a[:, None] != b[None, :])
        linked = near @ others["copies"].to_numpy()
        names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        roots = np.arange(len(names))
        i, j = np.nonzero(near)
        merge(roots, at[: len(a)][i], at[len(a) :][j])
        joined = np.flatnonzero(roots != np.arange(len(names)))
        some = linked > 0
        return pd.DataFrame(
            {
                "u": np.concatenate([a[some], names[joined]]),
                "v": np.concatenate([a[some], names[roots[joined]]]),
                "n": np.concatenate([linked[some], np.zeros(len(joined), np.int64)]),
            }
        )

    layout, path = placed.schema, placed.durable_path
    asked, others = side("asked", "homes", "parts"), side("others", "parts", "homes")
    found = asked.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInPandas(compare, "u long, v long, n long")
    found = durable(found, "vectors-links")
    discard(placed)
    counts = found.where("n > 0").groupBy("u").agg(F.sum("n").alias("linked"))
    roots = components(found.where("n = 0").select("u", "v"))
    of_rep = (
        groups.select("rep", "first", "copies")
        .join(counts.withColumnRenamed("u", "rep"), "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", "first", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    least = of_rep.groupBy("root").agg(F.min("first").alias("component_id"))
    of_rep = of_rep.join(least, "root").select("rep", "n_links", "component_id")
    of_row = member.select("vec_id", "rep").join(of_rep, "rep").select("vec_id", "n_links", "component_id")
    alone = every.where("not coalesce(usable, false) or vec_id is null or label is null")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return of_row.unionByName(alone).withColumn("kept", kept)
