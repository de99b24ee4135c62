"""Release packaging: zip archives with a manifest, on the driver, over written trees."""

from __future__ import annotations

import json
import subprocess
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_version(repository: str, fallback: str = "v0.0.0") -> str:
    """The latest version tag of a git repository, else the fallback."""
    done = subprocess.run(["git", "-C", repository, "tag", "--sort=-v:refname"], capture_output=True, text=True)
    tags = done.stdout.split()
    return tags[0] if done.returncode == 0 and tags else fallback


def zip_tree(trees: dict[str, str], archive: str, pattern: str = "*") -> dict:
    """Archive the files of each tree below its name; returns file count and size."""
    count = 0
    Path(archive).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for name, root in trees.items():
            for file in sorted(Path(root).rglob(pattern)):
                if file.is_file():
                    out.write(file, str(Path(name, file.relative_to(root))))
                    count += 1
    return {"file": Path(archive).name, "file_count": count, "size_bytes": Path(archive).stat().st_size}


def write_manifest(packages: list[dict], version: str, path: str) -> dict:
    manifest = {"version": version, "packages": packages, "total_size_bytes": sum(p["size_bytes"] for p in packages)}
    Path(path).write_text(json.dumps(manifest, indent=2), encoding="utf-8")
    return manifest


def manifest_checks(spark: SparkSession, path: str, packages: list[str]) -> DataFrame:
    """Checks of a manifest: its version, the packages it must name, its total against theirs."""
    found = spark.read.schema("version string, packages array<struct<file:string,file_count:bigint,size_bytes:bigint>>, total_size_bytes bigint").option("multiLine", "true").json(path)
    total = F.aggregate("packages", F.lit(0).cast("long"), lambda n, p: n + p["size_bytes"])
    lacking = F.array_except(F.array(*[F.lit(p) for p in packages]).cast("array<string>"), F.coalesce(F.col("packages")["file"], F.array().cast("array<string>")))
    tests = {
        "version": (F.col("version").rlike(r"^v?\d+\.\d+\.\d+"), F.col("version")), "packages": (F.size(lacking) == 0, F.array_join(lacking, ", ")),
        "total size": (total == F.col("total_size_bytes"), F.col("total_size_bytes").cast("string")),
    }
    rows = F.inline(F.array(*[F.struct(F.lit(k).alias("name"), F.lit("error").alias("severity"), F.coalesce(ok, F.lit(False)).alias("passed"), F.coalesce(detail, F.lit("")).alias("detail")) for k, (ok, detail) in tests.items()]))
    return found.select(rows)


def archive_entries(spark: SparkSession, archive: str) -> DataFrame:
    """name, size of an archive's files; a damaged archive raises."""
    with zipfile.ZipFile(archive) as z:
        if (bad := z.testzip()) is not None:
            raise zipfile.BadZipFile(bad)
        rows = [(i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
    return spark.createDataFrame(rows, "name string, size bigint")


def package_checks(entries: DataFrame, expected_dirs: list[str], least_files: int) -> DataFrame:
    """One row: files, bytes, whether there are enough files and every expected directory."""
    top = F.collect_set(F.substring_index("name", "/", 1))
    missing = F.array_except(F.array(*[F.lit(d) for d in expected_dirs]).cast("array<string>"), top)
    return entries.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), (F.count("*") >= least_files).alias("enough"), F.array_join(missing, ",").alias("missing_dirs"))


def copy_tree_except(source: str, target: str, skipped: str = "examples") -> int:
    """Copy a written tree but for one child directory; returns how many Markdown files."""
    import shutil

    n = 0
    for file in sorted(Path(source).rglob("*")):
        relative = file.relative_to(source)
        if file.is_file() and relative.parts[0] != skipped:
            (Path(target) / relative).parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(file, Path(target) / relative)
            n += file.suffix == ".md"
    return n
