"""Several tables that change together: staged folders, and a manifest written last.

A run writes its tables under a folder of its own, `TARGET/_parts/<id>/<table>`. `commit` then puts a manifest in place that names
the parts of the new version, by one rename; readers follow the manifest with the highest number. A run that ends before
that leaves the former version as it was, and no folder is ever written twice, so a retry has nothing to clear away first.
Parts that no manifest names, and versions that are not wanted any more, stay until `remove_old`.

One run at a time commits to a target; a second one that began from the same version fails at its commit.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cuadre.sources.files import CSV_OPTIONS

_MANIFEST = re.compile(r"(\d{9})\.json$")


@dataclass(frozen=True)
class Version:
    """`number` 0 is a target without a commit."""

    number: int = 0
    parts: list[str] = field(default_factory=list)
    fmt: str = "parquet"
    schemas: dict[str, str] = field(default_factory=dict)


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _manifests(spark: SparkSession, target: str) -> dict[int, str]:
    store, place = _store(spark, f"{target}/_manifests")
    if not store.exists(place):
        return {}
    found = (str(status.getPath().getName()) for status in store.listStatus(place))
    return {int(m[1]): f"{target}/_manifests/{m[0]}" for name in found if (m := _MANIFEST.fullmatch(name))}


def _read(spark: SparkSession, path: str, number: int) -> Version:
    content = json.loads(spark.read.option("wholetext", "true").text(path).first()[0])
    return Version(number, content["parts"], content["format"], content["schemas"])


def current(spark: SparkSession, target: str) -> Version:
    """The version that readers see."""
    found = _manifests(spark, target)
    return _read(spark, found[max(found)], max(found)) if found else Version()


def new_part(target: str) -> str:
    """A folder for the tables of a run."""
    return f"{target}/_parts/{uuid.uuid4().hex}"


def commit(spark: SparkSession, target: str, before: Version, part: str, fmt: str, schemas: dict[str, StructType], append: bool = False) -> Version:
    """Makes `part` the version after `before`, or with `append` adds it to what `before` has."""
    if append and before.number and (before.fmt, before.schemas) != (fmt, {n: s.json() for n, s in schemas.items()}):
        raise ValueError("what is added has another format or other tables or columns")
    parts = [*(before.parts if append else []), part.rpartition("/")[2]]
    version = Version(before.number + 1, parts, fmt, {name: schema.json() for name, schema in schemas.items()})
    store, staged = _store(spark, f"{target}/_manifests/.{uuid.uuid4().hex}")
    out = store.create(staged, False)
    out.write(bytearray(json.dumps({"parts": parts, "format": fmt, "schemas": version.schemas}).encode()))
    out.close()
    place = _store(spark, f"{target}/_manifests/{version.number:09d}.json")[1]
    if store.exists(place) or not store.rename(staged, place):
        raise RuntimeError(f"another run has committed to {target}")
    return version


def read(spark: SparkSession, target: str, name: str, version: Version | None = None) -> DataFrame:
    """A table of the current version, or of another that `history` gives."""
    version = version or current(spark, target)
    if name not in version.schemas:
        raise ValueError(f"{target} has no committed table {name!r}")
    options = {**CSV_OPTIONS, "multiLine": "true"} if version.fmt == "csv" else {}
    paths = [f"{target}/_parts/{part}/{name}" for part in version.parts]
    return spark.read.schema(StructType.fromJson(json.loads(version.schemas[name]))).options(**options).format(version.fmt).load(paths)


def history(spark: SparkSession, target: str) -> list[Version]:
    """All committed versions, the oldest first."""
    return [_read(spark, path, number) for number, path in sorted(_manifests(spark, target).items())]


def remove_old(spark: SparkSession, target: str, keep: int = 1) -> list[str]:
    """Removes all but the last `keep` versions, with parts that none of these has. No run and no reader of an older
    version may be under way. Returns the parts removed."""
    versions = history(spark, target)
    wanted = {part for version in versions[-keep:] for part in version.parts}
    for version in versions[:-keep]:
        store, place = _store(spark, f"{target}/_manifests/{version.number:09d}.json")
        store.delete(place, False)
    store, top = _store(spark, f"{target}/_parts")
    gone = [str(s.getPath().getName()) for s in store.listStatus(top)] if store.exists(top) else []
    gone = [name for name in gone if name not in wanted]
    for name in gone:
        store.delete(_store(spark, f"{target}/_parts/{name}")[1], True)
    return gone
