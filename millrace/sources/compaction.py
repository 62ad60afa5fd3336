"""Compaction of append-only tables of many small files, while others append and read.

A table has files in its own folder and in folders below it (the ledger: one folder a job, one
a run below that). Each folder directly below the table, and the table's own files, are one
unit. Compaction rewrites the small files of all units in one Spark job into hidden folders and
publishes one manifest a unit: which files hold the unit's rows now, and which files they stand
for. A reader takes what the newest manifests name and every file that none of them stands for.

* A manifest appears whole by a rename that fails where its name is taken, so of two
  compactions that meet one publishes a unit and the other leaves it as it was. This needs a
  file system that renames in one step (HDFS); elsewhere run one compaction at a time.
* Readers look at the manifests before and after they list files and begin anew if one has
  appeared, so each row is seen once. What a manifest stands for is deleted only after
  `keep_seconds`, so plans that were made before can still be run.
* Rewritten files are merged again with later ones of their size, as in a binary counter: a
  row is rewritten as often as the logarithm of the appends, and as many files stay.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.tables import write_table

# Spark's readers skip names that begin with an underscore.
MANIFESTS = "_manifest"
REWRITTEN = "_compacted"


class _Folder:
    """Small file operations of the driver on one table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.system = root.getFileSystem(self.conf)
        self.root = root.makeQualified(self.system.getUri(), self.system.getWorkingDirectory())

    def path(self, name: str):
        fs = self.jvm.org.apache.hadoop.fs
        return fs.Path(self.root, name) if name else self.root

    def names(self, pattern: str) -> list[str]:
        """Paths below the table that match a pattern, relative to it."""
        found = self.system.globStatus(self.path(pattern)) or []
        return [_relative(self.root.toString(), s.getPath().toString()) for s in found]

    def text(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Make a file appear whole under a name, unless the name is taken."""
        draft = self.path(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = self.system.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs = self.jvm.org.apache.hadoop.fs
        no_options = self.spark._sc._gateway.new_array(fs.Options.Rename, 0)
        try:
            fs.FileContext.getFileContext(self.root.toUri(), self.conf).rename(
                draft, self.path(name), no_options
            )
        except Exception:
            if not self.system.exists(self.path(name)):
                raise
            self.system.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)

    def listed(self) -> list[str]:
        """The table's files as Spark lists them, hidden ones left out, relative to it."""
        files = self.reader().parquet(self.root.toString())._jdf.inputFiles()
        return [_relative(self.root.toString(), unquote(f)) for f in files]

    def reader(self, schema: T.StructType | None = None):
        return self.spark.read.schema(schema or "none int").option("recursiveFileLookup", True)

    def rows(self, names: list[str], schema: T.StructType) -> DataFrame:
        return self.reader(schema).parquet(*[self.path(n).toString() for n in sorted(names)])

    def manifests(self) -> dict[str, int]:
        """The newest manifest of every unit, by its number."""
        newest: dict[str, int] = {}
        for name in self.names(f"{MANIFESTS}/[0-9]*") + self.names(f"*/{MANIFESTS}/[0-9]*"):
            folder, _, number = name.rpartition("/")
            unit = folder.removesuffix(MANIFESTS).rstrip("/")
            newest[unit] = max(newest.get(unit, -1), int(number))
        return newest

    def own_files(self) -> list[str]:
        number = self.manifests().get("")
        return [] if number is None else list(self.manifest("", number)["files"])

    def manifest(self, unit: str, number: int) -> dict:
        return json.loads(self.text(_manifest_name(unit, number)))


def _manifest_name(unit: str, number: int) -> str:
    return f"{unit}/{MANIFESTS}/{number:020d}".lstrip("/")


def _relative(root: str, path: str) -> str:
    """A path below a root, whichever way its scheme is written (`file:/x`, `file:///x`)."""
    root, path = (re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", p).strip("/") for p in (root, path))
    if not path.startswith(root + "/"):
        raise ValueError(f"{path} is not below {root}")
    return path[len(root) + 1 :]


def _unit(name: str) -> str:
    return name.split("/")[0] if "/" in name else ""


def _state(folder: _Folder) -> tuple[dict[str, int], dict[str, dict], list[str]]:
    """Manifests and files of one moment: the manifests are the same before and after."""
    while True:
        newest = folder.manifests()
        try:
            manifests = {unit: folder.manifest(unit, n) for unit, n in newest.items()}
        except Exception:
            if folder.manifests() == newest:
                raise
            continue
        files = folder.listed()
        if folder.manifests() == newest:
            return newest, manifests, files


def read_compacted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table, or of one unit of it, each once, while others append and compact.

    A unit is read by its own folder: others are not listed. Files of a unit name those of its
    table, so a table may be moved as a whole only.
    """
    folder = _Folder(spark, path)
    plain = folder.reader(schema).parquet(path)
    if not folder.manifests():
        # A manifest that appears from here on stands for files that are kept long enough.
        return plain
    _, manifests, files = _state(folder)
    gone = {f"{u}/{f}".lstrip("/") for u, m in manifests.items() for f in m["covers"]}
    live = [f for f in files if f not in gone]
    live += [f"{u}/{f}".lstrip("/") for u, m in manifests.items() for f in m["files"]]
    return folder.rows(live, schema) if live else plain.limit(0)


def _merged(files: dict[str, int], fresh: int) -> list[str]:
    """Rewritten files, by how many appends each stands for, to be merged with fresh ones."""
    taken, weight = [], fresh
    for name, size in sorted(files.items(), key=lambda f: (f[1], f[0])):
        if size > 2 * weight:
            break
        taken.append(name)
        weight += size
    return taken


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    min_files: int = 8,
    keep_seconds: float = 86_400.0,
) -> int:
    """Rewrite the small files of every unit that has at least `min_files` new ones.

    Give the folder of the whole table, not that of a unit. Returns the number of units
    published. Files replaced more than `keep_seconds` ago are deleted first; keep them longer
    than the longest query and the longest compaction takes. Units that another compaction
    publishes meanwhile are left to it. A compaction that dies changes nothing that is read, and
    what it wrote is deleted by a later one. Files without rows are taken out as well.
    """
    if "unit" in schema.fieldNames():
        raise ValueError("a table with a column 'unit' cannot be compacted")
    folder = _Folder(spark, path)
    now = time.time()
    if any(n.startswith("../") for n in folder.own_files()):
        raise ValueError(f"{path} is one unit of a table; compact the table")
    _clean(folder, now - keep_seconds)
    newest, manifests, files = _state(folder)
    none = {"files": {}, "covers": {}}
    fresh = defaultdict(list)
    for name in files:
        unit = _unit(name)
        short = name[len(unit) :].lstrip("/")
        if short not in manifests.get(unit, none)["covers"]:
            fresh[unit].append(short)
    sources = {
        unit: [*names, *_merged(manifests.get(unit, none)["files"], len(names))]
        for unit, names in fresh.items()
        if len(names) >= max(min_files, 1)
    }
    published, listed = 0, set(files)
    if sources:
        written = _rewrite(folder, sources, schema)
        for unit, names in sources.items():
            old = manifests.get(unit, none)
            sizes = {n: old["files"].get(n, 1) for n in names}
            kept = {n: size for n, size in old["files"].items() if n not in sizes}
            # What is deleted already needs no line any more.
            covers = {
                n: at
                for n, at in old["covers"].items()
                if f"{unit}/{n}".lstrip("/") in listed or at > now - keep_seconds
            }
            state = {
                "files": kept | {n: sum(sizes.values()) for n in written[unit]},
                "covers": covers | {n: now for n in names},
            }
            number = newest.get(unit, -1) + 1
            if folder.publish(_manifest_name(unit, number), json.dumps(state)):
                published += 1
            else:
                for name in written[unit]:
                    folder.delete(f"{unit}/{name}")
    return published


def _rewrite(folder: _Folder, sources: dict[str, list[str]], schema) -> dict[str, list[str]]:
    """Write the rows of all units in one Spark job; the new files, relative to their unit.

    A unit's rows are found by the files they come from, so nothing is assumed of their columns.
    """
    names = [f"{unit}/{n}" if unit else n for unit, all_ in sources.items() for n in all_]
    spark, target = folder.spark, f"{REWRITTEN}/{uuid.uuid4().hex}"
    # Files below the table's own hidden folder belong to the unit that their folder names.
    stem = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", folder.root.toString()).strip("/")
    file = F.regexp_replace(
        F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))),
        "^[A-Za-z][A-Za-z0-9+.-]*:/*",
        "",
    )
    below = F.substr(file, F.lit(len(stem) + 2))
    again = F.regexp_extract(below, f"^{REWRITTEN}/[0-9a-f]+/unit=-([^/]*)/", 1)
    unit = (
        F.when(F.startswith(below, F.lit(f"{REWRITTEN}/")), again)
        .when(F.contains(below, F.lit("/")), F.substring_index(below, "/", 1))
        .otherwise("")
    )
    rows = folder.rows([_plain(n) for n in names], schema)
    rows = rows.withColumn("unit", F.concat(F.lit("-"), unit))
    write_table(rows, folder.path(target).toString(), mode="errorifexists", partition_by=["unit"])
    found = defaultdict(list)
    for name in folder.names(f"{target}/unit=*/part-*"):
        unit_name = unquote(name.split("/")[2].removeprefix("unit=-"))
        found[unit_name].append(f"../{name}" if unit_name else name)
    return found


def _plain(name: str) -> str:
    """`unit/../_compacted/x` as `_compacted/x`."""
    return re.sub(r"^[^/]+/\.\./", "", name)


def _clean(folder: _Folder, before: float) -> None:
    """Delete what was replaced before a moment, older manifests, and what no manifest names."""
    named = set()
    for unit, number in folder.manifests().items():
        state = folder.manifest(unit, number)
        for name, at in state["covers"].items():
            if at < before:
                folder.delete(f"{unit}/{name}".lstrip("/"))
        named |= {_plain(f"{unit}/{n}".lstrip("/")) for n in (*state["files"], *state["covers"])}
        for old in folder.names(f"{unit}/{MANIFESTS}/[0-9]*".lstrip("/")):
            if int(old.rpartition("/")[2]) < number - 1:
                folder.delete(old)
    in_use = {n.split("/")[1] for n in named if n.startswith(f"{REWRITTEN}/")}
    for name in folder.names(f"{REWRITTEN}/*"):
        changed = folder.system.getFileStatus(folder.path(name)).getModificationTime() / 1000
        if name.split("/")[1] not in in_use and changed < before:
            folder.delete(name)
