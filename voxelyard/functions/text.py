"""Small text, unit and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(c: Column) -> Column:
    """Runs of anything but letters and digits to one underline, none at the ends, lower case."""
    plain = F.lower(F.btrim(F.regexp_replace(c, "[^0-9A-Za-z]+", "_"), F.lit("_")))
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("tag"))


def bucket(body: Column, buckets: int = 4096) -> Column:
    """Folder of a body: h and three hexadecimal digits."""
    return F.concat(F.lit("h"), F.lpad(F.lower(F.hex(F.pmod(body, F.lit(buckets)))), 3, "0"))


def id_of(line: Column) -> Column:
    """Id at the start of a CSV line; null for a header or anything else."""
    cell = F.trim(F.split(line, ",")[0])
    return F.when(cell.rlike("^-*[0-9]+$"), F.try_to_number(F.regexp_replace(cell, "^-+", ""), F.lit("9" * 19)).cast("long") * F.when(cell.startswith("-"), -1).otherwise(1))


def human(nm: Column) -> Column:
    """Length with the unit that suits it."""
    cut = lambda v: F.format_string("%.1f", v)
    return F.when(F.abs(nm) >= 1e6, F.concat(cut(nm / 1e6), F.lit(" mm"))).when(F.abs(nm) >= 1e3, F.concat(cut(nm / 1e3), F.lit(" µm"))).otherwise(F.concat(cut(nm), F.lit(" nm")))


def bar(done: Column, total: Column, width: int = 20) -> Column:
    """Progress as a text of # and -."""
    full = F.least(F.floor(width * done / F.greatest(total, F.lit(1))), F.lit(width)).cast("int")
    return F.concat(F.repeat(F.lit("#"), full), F.repeat(F.lit("-"), width - full))


def minutes(started: Column, ended: Column) -> Column:
    return F.expr("1.0").cast("double") * (F.unix_micros(ended.cast("timestamp")) - F.unix_micros(started.cast("timestamp"))) / 60e6


def quantization_step(chunk: list[Column], lods: int, bits: int) -> Column:
    """Size of the smallest step of a mesh chunk's coordinates."""
    return F.greatest(*chunk) * 2.0 ** max(0, lods - 1) / 2.0**bits


def quantization_fails(step: Column, voxel: list[Column], bits: int) -> Column:
    if bits not in (10, 16):
        raise ValueError("vertices have 10 or 16 bits")
    return step * 4 > F.least(*voxel)


def scale_range(text: str, n: int) -> list[int]:
    """'all', 'a-b' or 'a,b,...' to scale numbers below n."""
    if text == "all":
        return list(range(n))
    out: list[int] = []
    for cell in text.split(","):
        a, _, b = cell.partition("-")
        out += range(int(a), int(b or a) + 1)
    if not out or any(k < 0 or k >= n for k in out):
        raise ValueError(f"scales are 0 to {n - 1}: {text!r}")
    return out


def path_cost(r: Column) -> Column:
    """Cost of a voxel on a traced path; infinite outside, where the radius is."""
    return F.when(F.abs(r) == float("inf"), float("inf")).otherwise(1 / (1 + r * r))
