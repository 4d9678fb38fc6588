"""The guided plan: cut where supporting reads don't span the motif, then pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strandloom.config import GuidedConfig
from strandloom.operators.cigar import split_alignments
from strandloom.operators.cut import guided_cuts, monomers
from strandloom.operators.merge import merge_blocks
from strandloom.operators.pairs import pair
from strandloom.operators.protect import protect, protect_sweep
from strandloom.operators.sites import locate_sites
from strandloom.operators.stats import guided_stats, observe
from strandloom.plans.buckets import bucketed


class Guided:
    """Lazy results of a guided run over reads and alignments of supporting reads on them.

    Spans are counted by a sweep; ``sweep=False`` takes the containment join, with ``bin_size`` in bins.
    """

    def __init__(self, reads: DataFrame, alignments: DataFrame, config: GuidedConfig | None = None, bin_size: int | None = None, sweep: bool = True):
        c = self.config = config or GuidedConfig()
        self.reads, self.bin_size, self.sweep = reads, bin_size, sweep and not bin_size
        self.sites = locate_sites(reads, c.motif, c.cut_offset)
        self.use_blocks(merge_blocks(split_alignments(alignments, c.max_gap), c.max_gap))

    def use_blocks(self, blocks: DataFrame) -> None:
        """Go on from these merged blocks, for instance from a kept stage's."""
        c, self.blocks = self.config, blocks
        spans = protect_sweep(self.sites, blocks, c.flank, c.min_cov, self.reads.select("read_idx", "len")) if self.sweep else protect(self.sites, blocks, c.flank, c.min_cov, self.bin_size)
        self.use_sites(spans)

    def use_sites(self, sites_final: DataFrame) -> None:
        """Cut at these sites, for instance at a kept stage's."""
        self.sites_final = sites_final
        self.cuts = guided_cuts(self.reads, sites_final, self.config.dup_motif, self.config.min_mono_len)

    @property
    def monomers(self) -> DataFrame:
        return monomers(self.cuts)

    @property
    def pairs(self) -> DataFrame:
        return pair(self.cuts, "all")

    def observed_pairs(self) -> tuple[DataFrame, Observation]:
        """Pairs, and the counters that come with them once they have been written."""
        cuts, seen = observe(self.cuts)
        return pair(cuts, "all"), seen

    @property
    def stats(self) -> DataFrame:
        return guided_stats(self.cuts)

    def problems(self) -> DataFrame:
        """(problem, n): sites of unknown reads, cuts lost on the way, sites counted twice. All 0 in a sound run."""
        unknown = self.sites_final.join(self.reads.select("read_idx"), "read_idx", "left_anti").agg(F.count("*").alias("n"))
        cut = self.sites_final.where(F.col("class") == "C").agg(F.count("*").alias("n"))
        applied = self.cuts.agg((-F.coalesce(F.sum("n_sites"), F.lit(0))).alias("n"))
        lost = cut.unionByName(applied).agg(F.sum("n").alias("n"))
        twice = self.sites_final.groupBy("read_idx", "motif_start").agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("n"))
        named = [(unknown, "sites_of_unknown_reads"), (lost, "cuts_not_applied"), (twice, "repeated_sites")]
        out = [df.select(F.lit(name).alias("problem"), "n") for df, name in named]
        return out[0].unionByName(out[1]).unionByName(out[2])


def bucketed_guided(reads: DataFrame, alignments: DataFrame, config: GuidedConfig | None = None, n: int = 64) -> Guided:
    """A guided run over reads and sites that are kept in ``n`` buckets of reads: sequences are shuffled once, for the first stage, and never for a join.

    A bucket's reads are read by one task, so ``n`` should be the bytes of all reads over what a task may hold.
    """
    g = Guided(bucketed(reads, "read_idx", n, "reads"), alignments, config)
    g.use_sites(bucketed(g.sites_final, "read_idx", n, "sites"))
    return g
