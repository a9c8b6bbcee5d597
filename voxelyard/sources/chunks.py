"""A volume of voxels in chunk files, and a data source that reads regions of it.

A volume is a folder: ``info.json`` (shape, block, voxel size), and for each block that holds any foreground a file
of its voxels' bodies, unsigned 64-bit little-endian in z, y, x order, compressed.  Reading it is a partition a block.
Comparisons of z, y, x with constants are taken over by the source: blocks outside of them are never
opened, and of those inside, the part that fits is cut out before a row is made.  Only the columns of the schema
that is asked for are built.

Files are reached through Arrow's file systems, so a path may be on any store that these know.
"""

from __future__ import annotations

import json
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds

from ..functions.frames import AXES, Box, block_of, in_box

SCHEMA = "z int, y int, x int, body_id long"
#: Rows of one Arrow batch at most, so that a large block needs little memory.
BATCH = 1 << 16


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _name(cell: tuple[int, int, int]) -> str:
    return "_".join(map(str, cell))


@dataclass(frozen=True)
class Info:
    shape: tuple[int, int, int]
    block: int
    nm: tuple[float, float, float]


def info(path: str) -> Info:
    store, at = _store(path)
    with store.open_input_stream(f"{at}/info.json") as f:
        held = json.loads(f.read())
    return Info(tuple(held["shape"]), held["block"], tuple(held["nm"]))


def write(voxels: DataFrame, path: str, shape: tuple[int, int, int], block: int = 64, nm: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> Info:
    """Writes voxels (z, y, x, body_id), of several at a place the smallest body, as chunks. A block goes to its file
    in one move, so a task that runs again replaces it; info.json comes last, and a volume without it isn't one."""
    if block < 1 or min(shape) < 1:
        raise ValueError(f"no volume of shape {shape} in blocks of {block}")
    cells = voxels.where((F.col("body_id") != 0) & in_box((0, 0, 0, *shape))).groupBy(*AXES).agg(F.min("body_id").alias("body_id"))

    def put(rows: pd.DataFrame) -> pd.DataFrame:
        cell = tuple(int(rows[f"b{a}"].iloc[0]) for a in AXES)
        size = [min(block, n - c * block) for n, c in zip(shape, cell)]
        dense = np.zeros(size, "<u8")
        dense[tuple(rows[a].to_numpy() - c * block for a, c in zip(AXES, cell))] = rows["body_id"].to_numpy()
        store, at = _store(path)
        fresh = f"{at}/chunks/.{_name(cell)}-{uuid.uuid4().hex}"
        with store.open_output_stream(fresh) as f:
            f.write(zlib.compress(dense.tobytes(), 1))
        store.move(fresh, f"{at}/chunks/{_name(cell)}")
        return pd.DataFrame({"n": [len(rows)]})

    store, at = _store(path)
    store.create_dir(f"{at}/chunks", recursive=True)
    cells.select(*AXES, "body_id", *block_of(block)).groupBy("bz", "by", "bx").applyInPandas(put, "n long").agg(F.sum("n")).collect()
    with store.open_output_stream(f"{at}/info.json") as f:
        f.write(json.dumps({"shape": list(shape), "block": block, "nm": list(nm)}).encode())
    return info(path)


@dataclass
class Chunk(ds.InputPartition):
    cell: tuple[int, int, int]

    def __init__(self, cell: tuple[int, int, int]):
        self.cell = cell


class Reader(ds.DataSourceReader):
    def __init__(self, schema, options):
        self.path, self.fields = options["path"], [(f.name, f.dataType.simpleString()) for f in schema.fields]
        if unknown := {n for n, _ in self.fields} - {*AXES, "body_id"}:
            raise ValueError(f"a volume has no columns {sorted(unknown)}")
        self.background = str(options.get("background", "false")).lower() == "true"
        self.info = info(self.path)
        self.low, self.high = [0, 0, 0], list(self.info.shape)

    def pushFilters(self, filters):
        """Takes bounds of z, y, x over, and gives back all other filters."""
        for f in filters:
            axis = AXES.index(f.attribute[0]) if isinstance(f, (ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual, ds.IsNotNull)) and f.attribute[0] in AXES else None
            if axis is None:
                yield f
            elif isinstance(f, (ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual)):
                self.low[axis] = max(self.low[axis], f.value + isinstance(f, ds.GreaterThan))
            if axis is not None and isinstance(f, (ds.EqualTo, ds.LessThan, ds.LessThanOrEqual)):
                self.high[axis] = min(self.high[axis], f.value + (not isinstance(f, ds.LessThan)))

    def partitions(self):
        """The blocks that the bounds meet; without background, those that have a file."""
        size = self.info.block
        spans = [range(max(0, a) // size, -(-max(0, b) // size)) if a < b else range(0) for a, b in zip(self.low, self.high)]
        if self.background:
            return [Chunk((z, y, x)) for z in spans[0] for y in spans[1] for x in spans[2]]
        from pyarrow import fs

        store, at = _store(self.path)
        names = [f.base_name for f in store.get_file_info(fs.FileSelector(f"{at}/chunks"))]
        cells = sorted(tuple(map(int, n.split("_"))) for n in names if not n.startswith("."))
        return [Chunk(c) for c in cells if all(i in s for i, s in zip(c, spans))]

    def read(self, partition):
        if partition is None:
            return
        size, first = self.info.block, [c * self.info.block for c in partition.cell]
        shape = [min(size, n - f) for n, f in zip(self.info.shape, first)]
        store, at = _store(self.path)
        name = f"{at}/chunks/{_name(partition.cell)}"
        if self.background and store.get_file_info(name).type.name == "NotFound":
            dense = np.zeros(shape, "<u8")
        else:
            with store.open_input_stream(name) as f:
                dense = np.frombuffer(zlib.decompress(f.read()), "<u8").reshape(shape)
        corner = [max(0, a - f) for a, f in zip(self.low, first)]
        part = dense[tuple(slice(c, max(c, min(n, b - f))) for c, n, b, f in zip(corner, shape, self.high, first))]
        flat = part.reshape(-1)
        places = np.arange(len(flat)) if self.background else np.flatnonzero(flat)
        for k in range(0, len(places), BATCH):
            own = places[k : k + BATCH]
            where = np.unravel_index(own, part.shape)
            built = {a: (lambda i=i: where[i] + first[i] + corner[i]) for i, a in enumerate(AXES)} | {"body_id": lambda: flat[own].astype(np.int64)}  # noqa: B023
            yield pa.RecordBatch.from_arrays([pa.array(built[n](), pa.int32() if t == "int" else pa.int64()) for n, t in self.fields], [n for n, _ in self.fields])


class Volume(ds.DataSource):
    """spark.read.format("voxel_chunks").option("path", …); option background: rows of background, too."""

    @classmethod
    def name(cls) -> str:
        return "voxel_chunks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(schema, self.options)


def read(spark: SparkSession, path: str, columns: str = SCHEMA, background: bool = False) -> DataFrame:
    """The voxels of a volume; filters on z, y, x decide which blocks are opened. columns is a schema."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Volume)
    return spark.read.format("voxel_chunks").schema(columns).option("path", path).option("background", str(background)).load()


def region(spark: SparkSession, path: str, box: Box, columns: str = SCHEMA, background: bool = False) -> DataFrame:
    """The voxels of a half-open box, in the volume's coordinates; the box must be within the volume."""
    shape = info(path).shape
    if any(a < 0 or b > n or a >= b for a, b, n in zip(box[:3], box[3:], shape)):
        raise ValueError(f"no region {box} in a volume of shape {shape}")
    return read(spark, path, columns, background).where(in_box(box))
