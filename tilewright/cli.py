"""Command line: ``python -m tilewright.cli build|count|check|render``."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
import time
from collections.abc import Sequence

from tilewright.config import BuildConfig


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tilewright")
    to = top.add_subparsers(dest="command", required=True)
    build = to.add_parser("build", help="build a detection dataset from slides and annotation files")
    build.add_argument("--wsi-path")
    build.add_argument("--geojson-path")
    build.add_argument("--output-dir")
    build.add_argument("--dry-run", action="store_true")
    build.add_argument("--config", help="JSON file of settings")
    count = to.add_parser("count", help="count annotations of all files of a folder")
    count.add_argument("directory")
    count.add_argument("-r", "--recursive", action="store_true")
    count.add_argument("--ext", nargs="+", default=[".geojson", ".json"])
    count.add_argument("--output")
    count.add_argument("--show-files", action="store_true")
    count.add_argument("--strict", action="store_true")
    count.add_argument("--sort", choices=("path", "count", "none"), default="path")
    check = to.add_parser("check", help="check a dataset and write samples with their boxes")
    check.add_argument("--dataset-dir", required=True)
    check.add_argument("--output-dir", required=True)
    check.add_argument("--samples-per-split-pos", type=int, default=100)
    check.add_argument("--samples-per-split-neg", type=int, default=100)
    check.add_argument("--allow-missing-negative-labels", action="store_true")
    render = to.add_parser("render", help="draw segmentation labels")
    render.add_argument("--label-dir", required=True)
    render.add_argument("--output-dir", required=True)
    render.add_argument("--image-dir")
    render.add_argument("--canvas-size", type=int, default=1024)
    render.add_argument("--max-files", type=int, default=10)
    render.add_argument("--no-overlay", action="store_true")
    return top


def settings(args: argparse.Namespace) -> BuildConfig:
    """Defaults, over them the settings file, over that the arguments."""
    given = {}
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            given = json.load(f)
    cfg = BuildConfig.of(given)
    if args.output_dir is not None:
        cfg = dataclasses.replace(cfg, output_dir=args.output_dir)
    return dataclasses.replace(cfg, dry_run=True) if args.dry_run else cfg


def _count(spark, args: argparse.Namespace) -> int:  # noqa: ANN001
    from tilewright.operators import geojson
    from tilewright.plans import tools
    from tilewright.sinks.dataset import put

    began = time.perf_counter()
    try:
        made = tools.count(spark, args.directory, recursive=args.recursive, suffixes=args.ext).persist()
    except (FileNotFoundError, NotADirectoryError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    rows = geojson.sorted_counts(made, args.sort).collect()
    if not rows:
        print("no annotation files")
        return 0
    total = geojson.count_totals(made).first()
    if args.show_files:
        for r in rows:
            print(f"{r['count']:8d}  {r['path']}" if r["ok"] else f"failed    {r['path']}  {r['error']}")
    if args.output:
        put(args.output, tools.as_csv(rows).encode())
    print(f"annotations: {total['total']}\nparsed files: {total['parsed']}\nfailed files: {total['failed']}\nseconds: {time.perf_counter() - began:.3f}")
    for r in rows:
        if not r["ok"]:
            print(f"  {r['path']}: {r['error']}", file=sys.stderr)
    return int(bool(total["failed"]) and args.strict)


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tilewright").getOrCreate()
    from tilewright.plans import build, tools

    if args.command == "build":
        cfg = settings(args)
        made = build.run(spark, cfg, args.wsi_path, args.geojson_path)
        if "totals" not in made:
            print("no slide has an annotation file")
        return 0
    if args.command == "count":
        return _count(spark, args)
    if args.command == "check":
        told = tools.check(spark, args.dataset_dir, args.output_dir, most_pos=args.samples_per_split_pos, most_neg=args.samples_per_split_neg, allow_missing=args.allow_missing_negative_labels)
        for r in told.orderBy("split").collect():
            print(", ".join(f"{k}={v}" for k, v in r.asDict().items()))
        return 0
    print(tools.render(spark, args.label_dir, args.output_dir, image_dir=None if args.no_overlay else args.image_dir, canvas=args.canvas_size, most=args.max_files))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
