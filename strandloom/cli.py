"""``python -m strandloom.cli digest reads.fastq.gz out``, ``windows reads.fastq.gz out`` and ``guided reads.fastq.gz alignments.paf out``.

A guided run begins with ``windows``: the FASTA files under ``out/windows`` are an aligner's queries, and ``guided``, with what it
made of them and the same ``out``, goes on from there. Parameters are environment variables named like the fields of the configurations in upper case.
"""

from __future__ import annotations

import argparse
import logging
import time
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from strandloom.config import DigestConfig, GuidedConfig, from_environment
from strandloom.operators.stats import DIGEST, GUIDED, observed_metrics
from strandloom.operators.windows import split_windows
from strandloom.plans.digest import Digest
from strandloom.plans.guided import Guided
from strandloom.plans.manifest import Manifest, clock
from strandloom.sources import sinks
from strandloom.sources.fastq import read_fastq
from strandloom.sources.fastq_chunks import write_chunks
from strandloom.sources.paf import id_problems, on_reads, read_paf


def _write_pairs(pairs: DataFrame, out: str, config: DigestConfig | GuidedConfig) -> None:
    if config.keep_chunks:
        write_chunks(pairs, f"{out}/chunks", config.gz_level)
    else:
        sinks.write_pairs(pairs, f"{out}/pairs", level=config.gz_level)


def _output(config: DigestConfig | GuidedConfig, *more: str) -> dict:
    """The parameters on which stages depend: all but those of the output."""
    return {k: v for k, v in asdict(config).items() if k not in ("pair_mode", "write_monomers", "gz_level", "keep_chunks", *more)}


def run_digest(spark: SparkSession, reads_path: str, out: str, config: DigestConfig) -> None:
    """Pairs, monomers if asked for, and statistics, which are written last and were counted as the pairs passed.

    Reads are parsed and cut once, in a stage that a later run takes up.
    """
    d = Digest(read_fastq(spark, reads_path), config)
    cuts = d.cuts
    d.use_cuts(Manifest(spark, f"{out}/stages").stage("cuts", lambda: cuts, path=reads_path, **_output(config)))
    pairs, seen = d.observed_pairs()
    _write_pairs(pairs, out, config)
    if config.write_monomers:
        sinks.write_monomers(d.monomers, f"{out}/monomers", level=config.gz_level)
    sinks.write_stats(observed_metrics(spark, seen, DIGEST), f"{out}/stats")


def _reads(stages: Manifest, reads_path: str) -> DataFrame:
    return stages.stage("reads", lambda: read_fastq(stages.spark, reads_path), path=reads_path)


def run_windows(spark: SparkSession, reads_path: str, out: str, config: GuidedConfig) -> None:
    """Stages of reads, their lengths and windows, and the windows as FASTA for an aligner."""
    # lengths and windows have manifests of their own, as a guided run goes on from the reads alone
    reads = _reads(Manifest(spark, f"{out}/stages"), reads_path)
    own = Manifest(spark, f"{out}/stages/windows")
    own.stage("genome", lambda: reads.select("read_idx", "read_id", "len"), path=reads_path)
    cut = lambda: split_windows(reads, config.window, config.window_overlap, keep=("read_id",))
    windows = own.stage("windows", cut, path=reads_path, window=config.window, overlap=config.window_overlap)
    sinks.write_windows(windows, f"{out}/windows", level=config.gz_level)


def run_guided(spark: SparkSession, reads_path: str, paf_path: str, out: str, config: GuidedConfig) -> None:
    """Pairs and the rest in stages that a later run takes up, with the table of sites; fails if a check does.

    Repeated read ids and alignments of reads that aren't there fail it before anything is cut.
    """
    stages, options = Manifest(spark, f"{out}/stages"), _output(config, "window", "window_overlap")
    reads = _reads(stages, reads_path)
    named = read_paf(spark, paf_path)
    _fail_on(id_problems(named, reads))
    alignments = stages.stage("alignments", lambda: on_reads(named, reads), path=paf_path)
    g = Guided(reads, alignments, config)
    blocks = g.blocks
    g.use_blocks(stages.stage("blocks", lambda: blocks, max_gap=config.max_gap))
    sites_final = g.sites_final
    g.use_sites(stages.stage("sites_final", lambda: sites_final, **options))
    _fail_on(g.problems())
    sinks.write_sites(g.sites_final, f"{out}/sites_final")
    pairs, seen = g.observed_pairs()
    _write_pairs(pairs, out, config)
    if config.write_monomers:
        sinks.write_monomers(g.monomers, f"{out}/monomers", level=config.gz_level)
    sinks.write_stats(observed_metrics(spark, seen, GUIDED), f"{out}/stats", labelled=False)


def _fail_on(problems: DataFrame) -> None:
    wrong = [r.asDict() for r in problems.where("n <> 0").collect()]
    if wrong:
        raise RuntimeError(f"checks failed: {wrong}")


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    digest, windows, guided = (commands.add_parser(c) for c in ("digest", "windows", "guided"))
    for p in (digest, windows, guided):
        p.add_argument("reads")
    guided.add_argument("alignments")
    for p in (digest, windows, guided):
        p.add_argument("out")
    a = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s")
    spark = SparkSession.builder.appName(f"strandloom {a.command}").getOrCreate()
    began = time.time()
    if a.command == "digest":
        run_digest(spark, a.reads, a.out, from_environment(DigestConfig))
    elif a.command == "windows":
        run_windows(spark, a.reads, a.out, from_environment(GuidedConfig))
    else:
        run_guided(spark, a.reads, a.alignments, a.out, from_environment(GuidedConfig))
    logging.getLogger(__name__).info("done in %s", clock(time.time() - began))


if __name__ == "__main__":
    main()
