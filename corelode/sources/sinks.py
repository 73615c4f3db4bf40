"""Writers: ordered Parquet, CSV exports, manifests and the checks between them."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def write(df: DataFrame, path: str, *order: str, level: int | None = None, single: bool = False) -> None:
    """Parquet in a total order, ZSTD; ``single`` for tables of kilobytes only."""
    out = df.orderBy(*order) if order else df
    if single:
        out = df.coalesce(1).sortWithinPartitions(*order) if order else df.coalesce(1)
    w = out.write.mode("overwrite").option("compression", "zstd")
    if level is not None:
        w = w.option("parquet.compression.codec.zstd.level", str(level))
    w.parquet(path)


def replace(df: DataFrame, path: str, *order: str, check: Callable[[DataFrame], None] | None = None, source: str | None = None) -> None:
    """Write beside the target, check what was written, then rename over it.

    The rename goes through the file system of the path.  A failed check leaves the
    target as it was.  The input of the job is never its output.
    """
    if source is not None and source.rstrip("/") == path.rstrip("/"):
        raise ValueError("the output would overwrite the input")
    spark = df.sparkSession
    temp = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    write(df, temp, *order)
    fs, p = _fs(spark, path)
    q = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(temp)
    try:
        if check is not None:
            check(spark.read.parquet(temp))
    except Exception:
        fs.delete(q, True)
        raise
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{uuid.uuid4().hex}.old")
    swap(fs, q, p, old)


def swap(fs, new, target, old) -> None:
    """Rename ``new`` to ``target``; what was there goes to ``old`` and is deleted last.

    File systems report a failed rename by returning false, so every result is
    checked; if the new table cannot take the place, the old one is put back.
    """
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        fs.delete(new, True)
        raise OSError(f"{target} could not be set aside")
    try:
        done = fs.rename(new, target)
    except Exception:
        done = False
    if not done:
        if had and not fs.rename(old, target):
            raise OSError(f"{target} is at {old}: neither the new table nor the old one could be moved there")
        fs.delete(new, True)
        raise OSError(f"the new table could not be moved to {target}")
    if had:
        fs.delete(old, True)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_csv(lines: DataFrame, path: str, header: Sequence[str]) -> int:
    """An export of guarded lines as one file with CRLF ends; returns the number of rows.

    The export is capped, so its rows fit the driver, which streams them.
    """
    n = 0
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(",".join(header))
        for r in lines.toLocalIterator():
            f.write("\r\n" + r[0])
            n += 1
    return n


def sha256(path: str) -> str:
    """Of a file, or of a folder's files in order of their names."""
    h = hashlib.sha256()
    files = [path] if os.path.isfile(path) else sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if not f.startswith((".", "_")))
    for name in files:
        with open(name, "rb") as f:
            while block := f.read(1 << 20):
                h.update(block)
    return h.hexdigest()


def manifest(spark: SparkSession, inputs: Mapping[str, str], outputs: Mapping[str, str], argv: Sequence[str] = ()) -> dict:
    """What a build read and wrote: digests, rows, schemas, command, versions."""
    facts = {}
    for name, path in outputs.items():
        df = spark.read.parquet(path)
        facts[name] = {"path": os.path.basename(path), "sha256": sha256(path), "rows": df.count(), "schema": [list(x) for x in df.dtypes]}
    return {"inputs": {n: {"path": os.path.basename(p), "sha256": sha256(p)} for n, p in inputs.items()}, "outputs": facts, "argv": list(argv), "versions": {"spark": spark.version}}


def save_json(data: Mapping, path: str) -> None:
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(temp, "w", encoding="utf-8") as f:
        json.dump(data, f, indent=2, sort_keys=True)
    os.replace(temp, path)


def verify_manifest(data: Mapping, folder: str) -> list[str]:
    """Outputs whose digest is not what the manifest says, or that are missing."""
    bad = []
    for name, m in data["outputs"].items():
        path = os.path.join(folder, m["path"])
        if not os.path.exists(path):
            bad.append(f"{name}: missing")
        elif sha256(path) != m["sha256"]:
            bad.append(f"{name}: changed")
    return bad


def release_manifest(folder: str, required: Sequence[str], inventory: Mapping[str, int]) -> dict:
    """Sizes and digests of all files of a release.

    Every required file must be there, and the counts of base and hot files must add
    up to the total; otherwise nothing is returned.
    """
    missing = [f for f in required if not os.path.exists(os.path.join(folder, f))]
    if missing:
        raise FileNotFoundError("missing: " + ", ".join(missing))
    if inventory.get("base", 0) + inventory.get("hot", 0) != inventory.get("total", 0):
        raise ValueError(f"the inventory does not add up: {dict(inventory)}")
    files = {}
    for f in required:
        p = os.path.join(folder, f)
        size = os.path.getsize(p) if os.path.isfile(p) else sum(os.path.getsize(os.path.join(d, x)) for d, _, xs in os.walk(p) for x in xs)
        files[f] = {"bytes": size, "sha256": sha256(p)}
    return {"files": files, "inventory": dict(inventory)}


def pinned_against(pinned: Sequence[str], published: Sequence[str]) -> dict[str, list[str]]:
    """What one side has and the other lacks."""
    return {"missing": sorted(set(pinned) - set(published)), "extra": sorted(set(published) - set(pinned))}


def drift(source: Mapping[str, str], mirror: Mapping[str, str]) -> tuple[int, list[str]]:
    """(exit code, flavours): 0 all tags equal, 1 some differ, 2 some cannot be compared."""
    unknown = sorted(k for k in source if k not in mirror or not source[k] or not mirror.get(k))
    differ = sorted(k for k in source if k not in unknown and source[k].strip('"') != mirror[k].strip('"'))
    return (2, unknown) if unknown else (1, differ) if differ else (0, [])


def remove(path: str) -> None:
    shutil.rmtree(path, ignore_errors=True)
