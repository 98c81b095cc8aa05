"""Results of slides: totals, localised status, report and summary."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.config import BuildConfig

# Counters of a slide, and how a status is shown.
COUNTERS = ("raw_pos", "raw_neg", "written_train", "written_val", "failed_neg", "neg_reject_duplicate", "neg_reject_annotation", "neg_reject_low_tissue", "neg_reject_try_limit")
STATUS_TEXT = {"ok": "成功", "skipped": "跳过", "failed": "失败"}
SKIP_TEXT = {"empty_annotations": "空 annotation"}


def totals(results: DataFrame) -> DataFrame:
    """One row: sums of all counters (null: 0), and slides by status; an unknown status counts as failed."""
    s = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    status = F.coalesce("status", F.lit("ok"))
    ok, skipped = status == "ok", status == "skipped"
    return results.agg(*s, F.count_if(ok).alias("slides_ok"), F.count_if(skipped).alias("slides_skipped"), F.count_if(~ok & ~skipped).alias("slides_failed"))


def _named(value: Column, names: dict[str, str], otherwise: Column) -> Column:
    out = otherwise
    for k, v in names.items():
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


def with_status_text(results: DataFrame) -> DataFrame:
    """Results with their status in words; an unknown status stands for itself. skip_reason_text is null where nothing was skipped."""
    out = results.withColumn("status_text", _named(F.col("status"), STATUS_TEXT, F.col("status")))
    return out.withColumn("skip_reason_text", _named(F.col("skip_reason"), SKIP_TEXT, F.lit(None).cast("string")))


def report(cfg: BuildConfig, discovery: dict, results: DataFrame, total: dict) -> dict:
    """What a build report says. One row a slide is gathered, as the report is one document."""
    slides = [{k: v for k, v in r.asDict().items() if v is not None} for r in with_status_text(results).orderBy("slide_stem").collect()]
    return {"config": cfg.report_block(), "discovery": discovery, "slides": slides, "totals": total, "output_dir": cfg.output_dir}


def as_json(document: dict) -> str:
    return json.dumps(document, indent=2, ensure_ascii=False, default=str)


def summary(total: dict, output_dir: str) -> list[str]:
    """Lines for the console."""
    out = [
        f"slides: ok={total['slides_ok']} skipped={total['slides_skipped']} failed={total['slides_failed']}",
        f"positive tiles: {total['raw_pos']}",
        f"negative tiles: {total['raw_neg']}",
        f"train images: {total['written_train']}",
        f"val images: {total['written_val']}",
        f"images: {total['written_train'] + total['written_val']}",
        f"output: {output_dir}",
    ]
    if total["failed_neg"]:
        out.append(f"negatives short of their target: {total['failed_neg']}")
    rejects = {k.removeprefix("neg_reject_"): v for k, v in total.items() if k.startswith("neg_reject_")}
    if any(rejects.values()):
        out.append("rejected tries: " + " ".join(f"{k}={v}" for k, v in rejects.items()))
    return out


def slide_line(result: dict) -> str:
    """A slide's result on one line."""
    error = f" error={result['error']}" if result.get("error") else ""
    return f"[{STATUS_TEXT.get(result['status'], result['status'])}] {result['slide_stem']} pos={result['raw_pos']} neg={result['raw_neg']} train={result['written_train']} val={result['written_val']} short={result['failed_neg']}{error}"
