"""Command line: build, align, table, stats and diagnose."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import replace
from importlib import import_module

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.gates import duration_band
from .operators import reports
from .plans import aligned_path, diagnose, training_table, turn_path
from .plans.plugins import Plugins
from .settings import load_settings
from .sources.audio import read_clips
from .sources.manifests import default_roots


def _named(place: str) -> Callable:
    """What stands at module:function."""
    module, _, name = place.partition(":")
    return getattr(import_module(module), name)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="voxloom", description=__doc__)
    sub = p.add_subparsers(dest="what", required=True)
    build = sub.add_parser("build", help="corpus folder to manifests")
    for name in ("--corpus", "--out"):
        build.add_argument(name, required=True)
    build.add_argument("--gold")
    for name, of in (("--vad", "speech detector"), ("--scorer", "scorer of texts against clips"), ("--transcriber", "second transcriber")):
        build.add_argument(name, help=f"module:function that makes the {of}")
    al = sub.add_parser("align", help="corpus folder to manifests by word alignment")
    for name in ("--corpus", "--out", "--aligner"):
        al.add_argument(name, required=True, help="module:function that makes the word aligner" if name == "--aligner" else None)
    al.add_argument("--gold")
    al.add_argument("--limit", type=int, default=0)
    al.add_argument("--keep-prep", action="store_true")
    build.add_argument("--no-align", action="store_true")
    build.add_argument("--no-second-asr", action="store_true")
    tab = sub.add_parser("table", help="manifests to a training table")
    for name in ("--manifest", "--clips", "--out"):
        tab.add_argument(name, required=True)
    tab.add_argument("--splits", default="train,test")
    tab.add_argument("--sr", type=int, default=16_000)
    tab.add_argument("--keep-silence", action="store_true")
    stats = sub.add_parser("stats", help="distribution of a manifest")
    stats.add_argument("manifest")
    diag = sub.add_parser("diagnose", help="every intermediate of a call")
    diag.add_argument("--dir", required=True)
    diag.add_argument("--dump")
    for x in (build, al):
        x.add_argument("--files", action="store_true", help="also write the clips as files, at the paths that the manifests name")
    for x in (build, al, diag):
        x.add_argument("--config")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("voxloom").getOrCreate()
    if a.what == "build":
        cfg = load_settings(a.config)
        cfg = replace(cfg, align=replace(cfg.align, enabled=cfg.align.enabled and not a.no_align), second_asr=replace(cfg.second_asr, enabled=cfg.second_asr.enabled and not a.no_second_asr))
        named = {k: _named(v) for k, v in (("vad", a.vad), ("scorer", a.scorer), ("transcriber", a.transcriber)) if v}
        turn_path.run(spark, a.corpus, a.out, cfg, Plugins(**named), a.gold, files=a.files).show(truncate=False)
    elif a.what == "align":
        aligned_path.run(spark, a.corpus, a.out, Plugins(word_aligner=_named(a.aligner)), load_settings(a.config), a.gold, a.limit, a.keep_prep, files=a.files).show(truncate=False)
    elif a.what == "table":
        clips = read_clips(spark, a.clips)
        splits = tuple(s.strip() for s in a.splits.split(",") if s.strip())
        training_table.run(spark, a.manifest, clips, a.out, splits, tuple(default_roots(a.manifest)), a.keep_silence, a.sr).show(truncate=False)
    elif a.what == "stats":
        rows = spark.read.json(a.manifest)
        if not rows.take(1):
            print("empty manifest")
            return
        have = lambda name, kind: F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)
        rows = rows.select(
            have("duration", "double").alias("duration"), have("confidence", "double").alias("confidence"),
            F.coalesce(have("tier", "string"), F.lit("?")).alias("tier"), F.coalesce(have("source", "string"), F.lit("silver")).alias("source"),
        )
        for t in (reports.totals(rows), reports.shares(reports.counts(rows, duration_band(F.col("duration")), "band")), reports.counts(rows, F.col("tier"), "tier"), reports.counts(rows, F.col("source"), "source"), reports.confidence_histogram(rows).orderBy("bucket")):
            t.show(truncate=False)
    else:
        for name, t in diagnose.run(spark, a.dir, load_settings(a.config), dump_to=a.dump).items():
            print(f"=== {name} ===")
            t.show(100, truncate=False)


if __name__ == "__main__":
    main()
