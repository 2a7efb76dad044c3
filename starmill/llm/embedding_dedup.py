"""Near-duplicate embeddings by int8 tile products with error bounds.

Vectors of a label are dealt into tiles of about ``tile`` rows, and each pair of tiles of a label is compared by one
matrix product of int8 codes.  For a unit vector x = s q + e with codes q, |e| is computed with the codes, so that
|x.y - s_x s_y q_x.q_y| <= |e_x| + |e_y| (1 + |e_x|).  Only pairs that may reach the threshold within that bound are
computed again in double precision.  Each pair of tiles returns link counts per vector and a spanning forest of its
links, never the links themselves, so dense groups stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, merged, stored

#: What double rounding may add to a bound or a unit length.
SLACK = 1e-9
#: Products of int8 codes over so many dimensions stay exact in float32.
EXACT_DIMS = 1024
#: Candidate pairs that are recomputed at a time.
AT_ONCE = 1 << 16


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, error) of unit rows: row = scale * codes + rest, with the length of the rest at most error."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = unit - scale[:, None] * codes
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", rest, rest)) + SLACK


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of all rows of two int8 matrices."""
    total = 0.0
    for at in range(0, left.shape[1], EXACT_DIMS):
        a, b = (m[:, at : at + EXACT_DIMS].astype(np.float32) for m in (left, right))
        part = a @ b.T
        total = part if left.shape[1] <= EXACT_DIMS else total + part.astype(np.float64)
    return total


def linked(x: dict, y: dict, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of linked pairs of two tiles; of one tile with itself, those with i < j."""
    dots = products(x["codes"], y["codes"]) * x["scale"][:, None] * y["scale"][None, :]
    bound = x["error"][:, None] + y["error"][None, :] * (1 + x["error"][:, None])
    maybe = dots + bound >= threshold - SLACK
    if same:
        maybe = np.triu(maybe, 1)
    i, j = np.nonzero(maybe)
    keep = np.empty(len(i), bool)
    for at in range(0, len(i), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        a, b = x["full"][i[part]].astype(np.float64), y["full"][j[part]].astype(np.float64)
        norm = np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
        keep[part] = np.einsum("ij,ij->i", a, b) / norm >= threshold
    return i[keep], j[keep]


_MEMBER = ("ids", "weights", "codes", "scale", "error", "full")
TILE = ", ".join(["label_key {label}, dim int, tile long", *[f"{name} binary" for name in _MEMBER]])
PARTS = "node long, n_links long, root long"


def _packed(key: tuple, rows: pa.Table) -> pa.Table:
    """One tile as arrays of bytes.  Members are unit vectors in codes, and as they came."""
    dim = key[1].as_py()
    full = rows["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    wide = full.astype(np.float64)
    codes, scale, error = quantised(wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None])
    arrays = {
        "ids": rows["node"].to_numpy(),
        "weights": rows["weight"].to_numpy(),
        "codes": codes,
        "scale": scale,
        "error": error,
        "full": wide,
    }
    out = {"label_key": pa.array([key[0].as_py()], key[0].type), "dim": pa.array([dim], pa.int32())}
    out["tile"] = pa.array([key[2].as_py()], pa.int64())
    out |= {name: pa.array([a.tobytes()], pa.binary()) for name, a in arrays.items()}
    return pa.table(out)


def _unpacked(row: dict, dim: int) -> dict:
    kinds = {"ids": "i8", "weights": "i8", "codes": "i1", "scale": "f8", "error": "f8", "full": "f8"}
    tile = {name: np.frombuffer(row[name], kind) for name, kind in kinds.items()}
    return tile | {name: tile[name].reshape(-1, dim) for name in ("codes", "full")}


def _compared(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                x, y = _unpacked(row["x"], row["dim"]), _unpacked(row["y"], row["dim"])
                same = row["tile"] == row["other"]
                i, j = linked(x, y, threshold, same)
                ids, weights = x["ids"], x["weights"]
                if not same:
                    ids, weights = np.concatenate([ids, y["ids"]]), np.concatenate([weights, y["weights"]])
                    j = j + len(x["ids"])
                met = np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
                touched = np.nonzero(met)[0]
                root = merged(np.arange(len(ids)), i, j)
                yield pa.RecordBatch.from_pydict(
                    {"node": ids[touched], "n_links": met[touched].astype(np.int64), "root": ids[root[touched]]}
                )

    return compare


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    tile: int = 1024,
) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared only if their labels are equal and not null and they have as many components.  They link if
    their cosine is at least ``threshold``.  Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing.  Equal vectors of a label are compared once and count as often as they occur; rows that repeat an
    id are vectors of their own.  A null id links with nothing and is kept.  Other columns are ignored.  An empty table gives an empty result.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label_key"), F.col(vector_col).alias("vec")
    )
    finite = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    usable = F.col("label_key").isNotNull() & F.col("id").isNotNull() & finite & F.exists("vec", lambda v: v != 0)
    good = F.coalesce(usable, F.lit(False))
    # 128 bits stand for a vector: equal vectors are one node, named by the smallest id.
    copy_key = F.struct("label_key", F.xxhash64("vec"), F.xxhash64(F.lit(1), "vec"))
    rows = rows.withColumn("copy_key", F.when(good, copy_key))
    nodes = stored(
        rows.where("copy_key is not null")
        .groupBy("copy_key", "label_key")
        .agg(F.min("id").alias("node"), F.count("*").alias("weight"), F.min_by("vec", "id").alias("vec"))
        .withColumn("dim", F.size("vec"))
    )
    counts = stored(
        nodes.groupBy("label_key", "dim").agg(F.ceil(F.count("*") / tile).cast("long").alias("tiles"))
    )
    dealt = nodes.join(counts, ["label_key", "dim"]).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    kind = vectors.schema[label_col].dataType.simpleString()
    tiles = stored(
        dealt.select("label_key", "dim", "tile", "node", "weight", "vec")
        .groupBy("label_key", "dim", "tile")
        .applyInArrow(_packed, TILE.format(label=kind))
    )
    member = F.struct(*_MEMBER)
    other = F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("other")
    left = tiles.join(counts, ["label_key", "dim"]).select("label_key", "dim", "tile", other, member.alias("x"))
    right = tiles.select("label_key", "dim", F.col("tile").alias("other"), member.alias("y"))
    pairs = left.join(right, ["label_key", "dim", "other"])
    parts = stored(pairs.mapInArrow(_compared(threshold), PARTS))
    met = parts.groupBy("node").agg(F.sum("n_links").alias("met"))
    classes = components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = (
        nodes.select("copy_key", "node", "weight")
        .join(met, "node", "left")
        .join(classes, "node", "left")
        .select("copy_key", "node", "component", (F.col("weight") - 1 + F.coalesce("met", F.lit(0))).alias("links"))
    )
    component = F.coalesce("component", "node", "id")
    return rows.join(found, "copy_key", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
