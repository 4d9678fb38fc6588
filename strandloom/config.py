"""Parameters of the two programs, with their defaults and checks."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from strandloom.functions.motif import check_motif


@dataclass(frozen=True)
class DigestConfig:
    """Cut at every motif. ``dup_motif``: keep the motif on both monomers."""

    motif: str = "CATG"
    cut_offset: int = 4
    dup_motif: bool = False
    min_mono_len: int = 30
    pair_mode: str = "all"
    write_monomers: bool = False
    gz_level: int = 6
    keep_chunks: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "motif", check_motif(self.motif))
        if not 0 <= self.cut_offset <= len(self.motif):
            raise ValueError(f"cut_offset must be in [0, {len(self.motif)}]")
        if self.pair_mode not in ("all", "seq"):
            raise ValueError("pair_mode must be 'all' or 'seq'")


@dataclass(frozen=True)
class GuidedConfig:
    """Cut at motifs that fewer than ``min_cov`` distinct supporting reads span."""

    motif: str = "CATG"
    cut_offset: int = 4
    dup_motif: bool = True
    min_cov: int = 3
    flank: int = 15
    max_gap: int = 50
    min_mono_len: int | None = None
    write_monomers: bool = True
    window: int = 2000
    window_overlap: int = 250
    gz_level: int = 6
    keep_chunks: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "motif", check_motif(self.motif))
        if self.min_mono_len is None:
            object.__setattr__(self, "min_mono_len", self.flank + len(self.motif) + 1)
        if self.window > 0 and not 2 * self.flank < self.window_overlap <= self.window // 2:
            raise ValueError("window_overlap must be over 2 * flank and at most half of window")


def from_environment(kind: type, env: Mapping[str, str] | None = None):
    """A configuration from variables named like its fields in upper case; unset ones keep defaults."""
    env = os.environ if env is None else env
    values = {}
    for f in fields(kind):
        raw = env.get(f.name.upper())
        if raw not in (None, ""):
            values[f.name] = raw if f.name in ("motif", "pair_mode") else raw == "1" if f.name in ("dup_motif", "write_monomers", "keep_chunks") else int(raw)
    return kind(**values)
