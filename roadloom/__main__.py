"""Command line: convert scenario tables to binary files, or make affine variants of binary maps."""

from __future__ import annotations

import argparse
import dataclasses
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators import affine
from roadloom.plans import convert
from roadloom.schema import Scenarios
from roadloom.sources import binary


def parser() -> argparse.ArgumentParser:
    """All options; those of a conversion are the fields of its configuration."""
    p = argparse.ArgumentParser(prog="roadloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("convert", help="scenario tables (Parquet: header, tracks, elements, lights, zones, surfaces) to binary files")
    c.add_argument("source")
    c.add_argument("output")
    c.add_argument("--preset")
    c.add_argument("--presets", help="TOML file of presets")
    c.add_argument("--overwrite", action="store_true")
    for f in dataclasses.fields(convert.Config):
        name = f"--{f.name}"
        if f.type == "bool":
            c.add_argument(name, action="store_true", default=None)
        elif f.name == "datasets":
            c.add_argument(name, nargs="+", default=None)
        else:
            c.add_argument(name, type={"int": int, "float": float, "str": str}.get(f.type.split(" ")[0], str), default=None)
    a = sub.add_parser("augment", help="variants of static binary maps")
    a.add_argument("source")
    a.add_argument("output")
    a.add_argument("--groups", nargs="+", choices=list(affine.GROUPS))
    a.add_argument("--overwrite", action="store_true")
    return p


def convert_tables(spark: SparkSession, source: str, output: str, c: convert.Config, overwrite: bool = False) -> tuple[int, DataFrame]:
    """Convert all scenarios under ``source``; returns the exit code and the failures, which are also written as JSON lines beside the files.

    Duplicate file names stop the work before it starts; a scenario that fails validation before or after the stages,
    or can't be written, does not stop the others.
    """
    read = lambda t: spark.read.parquet(f"{source}/{t}")
    there = lambda t: read(t) if _exists(spark, f"{source}/{t}") else None
    s = Scenarios(read("header"), read("tracks"), read("elements"), there("lights"), there("zones"), there("surfaces"))
    if c.datasets:
        keep = s.header.filter(F.col("dataset").isin(list(c.datasets))).select("scenario_id")
        s = _only(s, keep)
    if c.num_scenes is not None:
        s = _only(s, s.header.orderBy("scenario_id").limit(c.num_scenes).select("scenario_id"))
    scenes = s.header.select("scenario_id", "dataset", F.col("name").alias("scene_uuid"), F.col("name").alias("log_name"), "location")
    names = convert.output_names(scenes, c.scenario_id_field)
    if twice := [r["path"] for r in convert.duplicate_names(names).limit(5).collect()]:
        raise ValueError(f"scenarios share file names: {twice}")
    good, bad = convert.checked(s, c) if c.validate_level else (s, s.header.select("scenario_id", F.lit("").alias("error")).limit(0))
    # kept, as validation, writing and the lists of failures all read them; a lost part is computed again
    bad = bad.persist()
    done = _kept(convert.run(good, c))
    whole = done
    if c.validate_level:
        after = dataclasses.replace(done, lights=None, zones=None)
        sound, worse = convert.checked(after, c)
        done, bad = dataclasses.replace(sound, controls=done.controls, distances=done.distances), bad.unionByName(worse)
    written = binary.write(binary.from_tables(done, names), output, overwrite).persist()
    failed = written.filter("not ok").select(F.col("path").alias("what"), "error").unionByName(bad.select(F.col("scenario_id").cast("string").alias("what"), "error"))
    n = written.filter("ok").count()
    failed.write.mode("overwrite").json(f"{output}/failures.jsonl")
    if c.emit_metadata:
        names.join(done.header.select("scenario_id", "name", "scenario_length", "dt"), "scenario_id").select(F.col("path").alias("bin_path"), F.col("name").alias("scenario_id"), "dataset", "scenario_length", "dt").write.mode("overwrite").json(f"{output}/metadata.jsonl")
    for t in (getattr(whole, f.name) for f in dataclasses.fields(whole)):
        if t is not None:
            t.unpersist()
    return convert.exit_code(s.header.count(), n), failed


def _kept(s: Scenarios) -> Scenarios:
    return Scenarios(**{f.name: None if (t := getattr(s, f.name)) is None else t.persist() for f in dataclasses.fields(s)})


def _only(s: Scenarios, ids: DataFrame) -> Scenarios:
    take = lambda t: None if t is None else t.join(ids, "scenario_id", "left_semi")
    return Scenarios(**{f.name: take(getattr(s, f.name)) for f in dataclasses.fields(s)})


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def augment_maps(spark: SparkSession, source: str, output: str, groups: list[str] | None = None, overwrite: bool = False) -> DataFrame:
    """Each static map and its variants, written to ``output``: (path, ok, error). Variants are made where the map is, one row each."""
    maps = binary.read(spark, source, static=True)
    if wrong := maps.filter("error is not null").select("path", "error").limit(3).collect():
        raise ValueError(f"no static maps: {[tuple(r) for r in wrong]}")
    catalogue = affine.catalogue(groups)
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.bin$", "")
    every = maps.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in ["", *catalogue]]))).withColumn("_stem", stem)
    name = F.when(F.col("variant") == "", F.col("_stem")).otherwise(F.concat_ws("_", "_stem", "variant"))
    every = every.withColumns({"path": F.concat(name, F.lit(".bin")), "name": F.when(F.col("variant") == "", F.col("name")).otherwise(name)})
    if twice := [r["path"] for r in convert.duplicate_names(every).limit(3).collect()]:
        raise ValueError(f"variants share file names: {twice}")
    return binary.write(binary.transformed(every, catalogue), output, overwrite)


def main(argv: list[str] | None = None) -> int:
    """Run a command."""
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("roadloom").getOrCreate()
    if args.command == "augment":
        failed = augment_maps(spark, args.source, args.output, args.groups, args.overwrite).filter("not ok").collect()
        for r in failed:
            print(f"{r['path']}: {r['error']}", file=sys.stderr)
        return 1 if failed else 0
    given = {f.name: v for f in dataclasses.fields(convert.Config) if (v := getattr(args, f.name)) is not None}
    presets = Path(args.presets).read_text() if args.presets else ""
    status, failed = convert_tables(spark, args.source, args.output, convert.configured(args.preset, presets, **given), args.overwrite)
    for r in failed.collect():
        print(f"{r['what']}: {r['error']}", file=sys.stderr)
    return status


if __name__ == "__main__":
    sys.exit(main())
