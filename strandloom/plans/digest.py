"""The digest plan: cut at every motif, then pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from strandloom.config import DigestConfig
from strandloom.operators.cut import digest_cuts, monomers
from strandloom.operators.pairs import pair
from strandloom.operators.stats import digest_stats, observe


class Digest:
    """Lazy results of a digest; none of them shuffles reads."""

    def __init__(self, reads: DataFrame, config: DigestConfig | None = None):
        c = self.config = config or DigestConfig()
        self.use_cuts(digest_cuts(reads, c.motif, c.cut_offset, c.dup_motif, c.min_mono_len))

    def use_cuts(self, cuts: DataFrame) -> None:
        """Go on from these cuts, for instance from a kept stage's."""
        self.cuts = cuts

    @property
    def monomers(self) -> DataFrame:
        return monomers(self.cuts)

    @property
    def pairs(self) -> DataFrame:
        return pair(self.cuts, self.config.pair_mode)

    def observed_pairs(self) -> tuple[DataFrame, Observation]:
        """Pairs, and the counters that come with them once they have been written."""
        cuts, seen = observe(self.cuts, self.config.pair_mode)
        return pair(cuts, self.config.pair_mode), seen

    @property
    def stats(self) -> DataFrame:
        return digest_stats(self.cuts, self.config.pair_mode)
