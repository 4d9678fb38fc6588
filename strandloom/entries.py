"""The registered queries of the read operators, and DuckDB SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.config import DigestConfig, GuidedConfig
from strandloom.functions.motif import motif_regex, reverse_complement_of
from strandloom.operators import align, chains, cigar, merge, protect, seeds, sites, stats, windows
from strandloom.plans.digest import Digest
from strandloom.plans.guided import Guided, bucketed_guided
from strandloom.plans.manifest import Manifest
from strandloom.scratch import scratch
from strandloom.sources.derived import BASES, LETTERS, derived_alignments, derived_reads
from strandloom.sources.fastq import read_fasta, read_fastq
from strandloom.sources.fastq_chunks import read_chunk_list, write_chunks
from strandloom.sources.fastq_source import register
from strandloom.sources.paf import on_reads, read_paf, write_paf
from strandloom.sources.sinks import monomer_records, pair_records, window_records, write_monomers, write_pairs, write_sites, write_stats, write_windows
from strandloom.streaming.digest_stream import streamed_fastq_stats, streamed_stats

Query = Callable[[SparkSession, str], DataFrame]


def _digest(**options) -> Callable[[SparkSession, str], Digest]:
    return lambda spark, d: Digest(derived_reads(spark, d), DigestConfig(**options))


def _guided(spark: SparkSession, d: str, **options) -> Guided:
    return Guided(derived_reads(spark, d), derived_alignments(spark, d), GuidedConfig(), **options)


def _hashed(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with sequences as md5, so that a result of long strings stays small."""
    return df.withColumns({c: F.md5(F.col(c)) for c in columns})


def _pairs(df: DataFrame) -> DataFrame:
    return _hashed(df.drop("read_id", "r1_qual", "r2_qual"), "r1_seq", "r2_seq")


def _monomers(df: DataFrame) -> DataFrame:
    return _hashed(df.drop("read_id", "qual"), "seq")


def _sites(motif: str, offset: int, overlap: bool, case: bool, interior: bool) -> Query:
    return lambda spark, d: sites.locate_sites(derived_reads(spark, d), motif, offset, overlap, case, interior)


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return cigar.split_alignments(derived_alignments(spark, d), 50)


def _paf_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The derived alignments written as PAF records of windows, every third without a CIGAR, read back and split."""
    a = derived_alignments(spark, d)
    total = F.aggregate(F.filter(cigar.cigar_ops(F.col("cigar")), lambda x: x["op"].isin("M", "D", "N")), F.lit(0).cast("bigint"), lambda n, x: n + x["len"])
    off = F.floor(F.col("q_start") / 1750) * 1750
    name = F.concat(F.lit("read"), F.col("read_idx"), F.lit("_W"), off)
    tag = F.when(F.col("t_start") % 3 == 0, F.lit("tp:A:P")).otherwise(F.concat(F.lit("cg:Z:"), "cigar"))
    fields = [name, F.lit(2000), F.col("q_start") - off, F.col("q_end") - off, F.col("strand"), F.col("target_id"), F.lit(300000), F.col("t_start"), F.col("t_start") + total, F.lit(0), F.lit(0), F.lit(60), tag]
    path = scratch(spark, "paf")
    a.select(F.concat_ws("\t", *[x.cast("string") for x in fields]).alias("value")).write.text(path)
    return cigar.split_alignments(on_reads(read_paf(spark, path), derived_reads(spark, d)), 50)


def _fastq_files(spark: SparkSession, d: str) -> DataFrame:
    """The reads as FASTQ files and back."""
    path = scratch(spark, "fastq")
    record = F.concat(F.lit("@"), "read_id", F.lit(" of the table\n"), "seq", F.lit("\n+\n"), "qual")
    derived_reads(spark, d).select(record.alias("value")).write.text(path)
    return _hashed(read_fastq(spark, path).drop("read_idx"), "seq", "qual")


def _wrapped(value: Column, width: int) -> Column:
    """Lines of ``width`` letters."""
    return F.regexp_replace(value, f"(.{{{width}}})(?=.)", "$1\n")


def _fastq_multiline(spark: SparkSession, d: str) -> DataFrame:
    """The reads as FASTQ records of many lines, whose qualities have lines that look like headers and separators, in ranges that cut records."""
    path = scratch(spark, "fastq-wrapped")
    qual = F.regexp_replace("qual", "(.{61}).{2}", "$1@+")
    record = F.concat(F.lit("@"), "read_id", F.lit("\n"), _wrapped(F.col("seq"), 60), F.lit("\n+\n"), _wrapped(qual, 61))
    derived_reads(spark, d).select(record.alias("value")).write.text(path)
    return _hashed(read_fastq(spark, path, range_bytes=200_000).drop("read_idx"), "seq", "qual")


def _fastq_source(spark: SparkSession, d: str) -> DataFrame:
    """Two columns of the reads from plain files in small ranges and from compressed ones, by the source's name."""
    path = scratch(spark, "fastq-source")
    record = F.concat(F.lit("@"), "read_id", F.lit("\tx\n"), "seq", F.lit("\n+\n"), "qual")
    reads = derived_reads(spark, d).select("read_idx", record.alias("value"))
    reads.where("read_idx % 2 = 0").select("value").write.text(f"{path}/plain")
    reads.where("read_idx % 2 = 1").select("value").write.text(f"{path}/packed", compression="gzip")
    register(spark)
    return spark.read.format("fastq").schema("read_id string, seq string").option("rangeBytes", 100_000).load(path).select("read_id", F.md5("seq").alias("seq"))


def _fastq_stream(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a digest over FASTQ files read as a stream."""
    path = scratch(spark, "fastq-stream")
    record = F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    derived_reads(spark, d).select(record.alias("value")).write.text(path, compression="gzip")
    return streamed_fastq_stats(spark, path, DigestConfig())


def _fasta_files(spark: SparkSession, d: str) -> DataFrame:
    """The reads as FASTA files with lines of 60 letters, and back."""
    path = scratch(spark, "fasta")
    record = F.concat(F.lit(">"), "read_id", F.lit("\n"), F.regexp_replace("seq", "(.{60})", "$1\n"))
    derived_reads(spark, d).select(record.alias("value")).write.text(path)
    return _hashed(read_fasta(spark, path), "seq")


def _pair_files(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of the paired files, read back."""
    path = scratch(spark, "pairs")
    write_pairs(_digest()(spark, d).pairs, path)
    sides = [read_fastq(spark, f"{path}/side={k}") for k in (1, 2)]
    return _hashed(sides[0].unionByName(sides[1]).select("read_id", "seq", "len"), "seq")


def _monomer_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "monomers")
    write_monomers(_digest()(spark, d).monomers, path)
    return _hashed(read_fastq(spark, path).select("read_id", "seq", "len"), "seq")


def _window_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "windows")
    write_windows(windows.split_windows(derived_reads(spark, d), keep=("read_id",)), path)
    return _hashed(read_fasta(spark, path), "seq")


def _sites_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "sites")
    write_sites(_guided(spark, d).sites_final, path)
    kept = "read_idx bigint, len bigint, motif_start bigint, motif_end bigint, x bigint, span bigint, class string"
    return spark.read.csv(path, sep="\t", schema=kept)


def _stats_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "stats")
    write_stats(_digest()(spark, d).stats, path)
    return spark.read.csv(path, sep="\t", header=True, schema="metric string, value bigint")


def _resumed_sites(spark: SparkSession, d: str) -> DataFrame:
    """Interior sites as a second run finds them: kept by the first."""
    path = scratch(spark, "stages")
    make = lambda: _sites("CATG", 4, True, False, True)(spark, d)
    Manifest(spark, path).stage("sites", make, motif="CATG")
    return Manifest(spark, path).stage("sites", lambda: make().limit(0), motif="CATG")


def _stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the stages of reads and their windows, from the manifest."""
    m = Manifest(spark, scratch(spark, "stages"))
    reads = m.stage("reads", lambda: derived_reads(spark, d))
    m.stage("windows", lambda: windows.split_windows(reads))
    return m.counts()


def _observed_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counters that were collected while the pairs were written."""
    pairs, seen = _digest()(spark, d).observed_pairs()
    write_pairs(pairs, scratch(spark, "observed-pairs"))
    return stats.observed_metrics(spark, seen, stats.DIGEST)


def _chunk_list(spark: SparkSession, d: str) -> DataFrame:
    """Pairs as the listed chunks hold them: both sides by name, each with the number of pairs that the list promises in all."""
    path = scratch(spark, "chunks")
    write_chunks(_digest()(spark, d).pairs, path)
    listed = read_chunk_list(spark, path).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("listed"))
    sides = []
    for k in (1, 2):
        side = read_fastq(spark, f"{path}/*_R{k}.fastq.gz") if listed.first()[0] else read_fastq(spark, f"{path}/*_R{k}.fastq.gz").limit(0)
        sides.append(side.select(F.regexp_replace("read_id", "/[12]$", "").alias("name"), F.md5("seq").alias(f"r{k}_seq")))
    return sides[0].join(sides[1], "name").join(F.broadcast(listed))


def _minimizers(spark: SparkSession, d: str) -> DataFrame:
    return seeds.minimizers(derived_reads(spark, d))


def _grouped_hits(spark: SparkSession, targets: DataFrame, queries: DataFrame | None = None, one_way: bool = False) -> DataFrame:
    """Seed hits of minimizers, by one shuffle that is kept: its counts give the mask."""
    path = scratch(spark, "grouped-seeds")
    seeds.grouped(targets, queries).write.parquet(path)
    groups = spark.read.schema(seeds.GROUPED).parquet(path)
    most = seeds.mid_occ_of(groups)
    if most > seeds.HELD:
        hits = seeds.seed_hits(targets if queries is None else queries, targets, most, to_itself=queries is not None)
        return hits.where("read_idx < target_idx") if one_way else hits
    return seeds.hits_of(groups, most, one_way)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    """Seed hits between all reads."""
    return _grouped_hits(spark, _minimizers(spark, d))


def _chains(spark: SparkSession, d: str) -> DataFrame:
    """Each hit is made in one order of its reads; its chain in the other comes from the same hits."""
    return chains.chains(_grouped_hits(spark, _minimizers(spark, d), one_way=True), seeds.K, both_ways=True)


def aligned_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of the reads, by the number of the read and the window's place, aligned to the other reads."""
    reads = derived_reads(spark, d)
    own = windows.split_windows(reads).select((F.shiftleft("read_idx", 20) + F.col("win_off")).alias("read_idx"), F.col("win_seq").alias("seq"))
    hits = _grouped_hits(spark, seeds.minimizers(reads), seeds.minimizers(own)).where(F.shiftright("read_idx", 20) != F.col("target_idx"))
    return align.align_chains(chains.chains(hits, seeds.K), own, reads)


def _aligned_paf(spark: SparkSession, d: str) -> DataFrame:
    """Alignments of windows written as PAF records, read back and split into blocks of the reads."""
    a = aligned_windows(spark, d)
    path = scratch(spark, "aligned")
    name = F.concat(F.lit("read"), F.shiftright("read_idx", 20), F.lit("_W"), F.col("read_idx") % (1 << 20))
    write_paf(a.withColumns({"read_id": name, "target_id": F.concat(F.lit("read"), "target_idx")}), path)
    return cigar.split_alignments(on_reads(read_paf(spark, path), derived_reads(spark, d)), 50)


def _records(df: DataFrame) -> DataFrame:
    return df.select("read_idx", F.md5("record").alias("record"))


DUP = {"dup_motif": True, "min_mono_len": 20}

QUERIES: dict[str, Query] = {
    "reads": lambda s, d: _hashed(derived_reads(s, d), "seq", "qual"),
    "genome_stats": lambda s, d: stats.genome_stats(derived_reads(s, d)),
    "reverse_complements": lambda s, d: derived_reads(s, d).select("read_idx", F.md5(reverse_complement_of(F.col("seq"))).alias("rc")),
    "digest_sites": _sites("CATG", 4, False, True, False),
    "interior_sites": _sites("CATG", 4, True, False, True),
    "iupac_sites": _sites("GANTC", 1, False, True, False),
    "overlapping_sites": _sites("CGCG", 2, True, False, False),
    "windows": lambda s, d: _hashed(windows.split_windows(derived_reads(s, d)), "win_seq"),
    "digest_monomers": lambda s, d: _monomers(_digest()(s, d).monomers),
    "digest_monomers_dup": lambda s, d: _monomers(_digest(**DUP)(s, d).monomers),
    "digest_pairs_all": lambda s, d: _pairs(_digest()(s, d).pairs),
    "digest_pairs_seq": lambda s, d: _pairs(_digest(pair_mode="seq")(s, d).pairs),
    "digest_pairs_dup": lambda s, d: _pairs(_digest(**DUP)(s, d).pairs),
    "digest_stats": lambda s, d: _digest()(s, d).stats,
    "digest_stats_dup_seq": lambda s, d: _digest(**DUP, pair_mode="seq")(s, d).stats,
    "digest_stats_stream": lambda s, d: streamed_stats(s, f"{d}/documents.parquet", DigestConfig()),
    "monomers_per_read": lambda s, d: stats.per_read(_digest()(s, d).cuts),
    "pair_records": lambda s, d: _records(pair_records(_digest()(s, d).pairs)),
    "monomer_records": lambda s, d: _records(monomer_records(_digest()(s, d).monomers)),
    "alignments": derived_alignments,
    "cigar_blocks": _blocks,
    "paf_blocks": _paf_blocks,
    "window_records": lambda s, d: _records(window_records(windows.split_windows(derived_reads(s, d), keep=("read_id",)))),
    "fastq_files": _fastq_files,
    "fastq_multiline": _fastq_multiline,
    "fastq_source": _fastq_source,
    "fastq_stream": _fastq_stream,
    "fasta_files": _fasta_files,
    "pair_files": _pair_files,
    "monomer_files": _monomer_files,
    "window_files": _window_files,
    "sites_file": _sites_file,
    "stats_file": _stats_file,
    "resumed_sites": _resumed_sites,
    "stage_counts": _stage_counts,
    "merged_blocks": lambda s, d: merge.merge_blocks(_blocks(s, d), 50),
    "reads_with_blocks": lambda s, d: merge.merge_blocks(_blocks(s, d), 50).agg(F.count_distinct("read_idx").alias("reads"), F.count("*").alias("blocks")),
    "sites_final": lambda s, d: _guided(s, d, sweep=False).sites_final,
    "sites_final_sweep": lambda s, d: _guided(s, d).sites_final,
    "sites_final_binned": lambda s, d: _guided(s, d, bin_size=1024).sites_final,
    "span_histogram": lambda s, d: protect.span_histogram(_guided(s, d).sites_final),
    "class_summary": lambda s, d: protect.class_summary(_guided(s, d).sites_final),
    "guided_monomers": lambda s, d: _monomers(_guided(s, d).monomers),
    "guided_pairs": lambda s, d: _pairs(_guided(s, d).pairs),
    "guided_stats": lambda s, d: _guided(s, d).stats,
    "guided_bucketed": lambda s, d: _pairs(bucketed_guided(derived_reads(s, d), derived_alignments(s, d), GuidedConfig(), n=8).pairs),
    "digest_observed_stats": _observed_stats,
    "chunk_list": _chunk_list,
    "minimizers": _minimizers,
    "seed_hits": _hits,
    "chains": _chains,
    "aligned_paf": _aligned_paf,
    "guided_problems": lambda s, d: _guided(s, d).problems(),
}

# --- DuckDB SQL: each query as a chain of common table expressions ---

_READS = f"""
reads as (
  select read_idx, seq, cast(length(seq) as bigint) as len from (
    select doc_id as read_idx, translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{LETTERS}', '{BASES}') as seq
    from documents
  )
)"""


def _sites_sql(motif: str, offset: int, interior: bool) -> str:
    n = len(motif)
    here = f"substr(seq, i + 1, {n})"
    test = f"{here} = '{motif}'" if set(motif) <= set("ACGT") else f"regexp_full_match({here}, '{motif_regex(motif)}')"
    within = f"where i + {offset} > 0 and i + {offset} < len" if interior else ""
    return f"""
sites as (
  select read_idx, len, cast(i as bigint) as motif_start, cast(i + {n} as bigint) as motif_end, cast(i + {offset} as bigint) as x from (
    select read_idx, len, seq, unnest(range(0, greatest(len - {n - 1}, 0))) as i from reads
  ) {within + " and" if interior else "where"} {test}
)"""


def _cut_sql(beg: str, end: str, min_len: int, source: str = "sites") -> str:
    return f"""
marks as (select read_idx, {beg} as b, {end} as e, row_number() over (partition by read_idx order by motif_start) as k from {source}),
begs as (select read_idx, k + 1 as k, b from marks union all select read_idx, 1, 0 from reads),
ends as (
  select read_idx, k, e from marks union all
  select r.read_idx, count(m.k) + 1, any_value(r.len) from reads r left join marks m on m.read_idx = r.read_idx group by r.read_idx
),
made as (select read_idx, k, b, e from begs join ends using (read_idx, k) where e > b),
kept as (
  select read_idx, cast(row_number() over (partition by read_idx order by k) as bigint) as rank, cast(b as bigint) as beg, cast(e as bigint) as "end"
  from made where e - b >= {min_len}
),
monomers as (select k.*, substr(r.seq, beg + 1, "end" - beg) as seq from kept k join reads r using (read_idx))"""


def _pairs_sql(mode: str) -> str:
    joined = "b.rank > a.rank" if mode == "all" else "b.rank = a.rank + 1"
    return f"""
pairs as (
  select a.read_idx, a.rank as i, b.rank as j, a.seq as r1_seq, b.seq as r2_seq
  from monomers a join monomers b on a.read_idx = b.read_idx and {joined}
)"""


_COUNTS = """
per as (
  select r.read_idx, (select count(*) from made m where m.read_idx = r.read_idx) as made, (select count(*) from kept k where k.read_idx = r.read_idx) as kept
  from reads r
)"""


def _stats_sql(names: tuple[str, ...], source: str = "sites") -> str:
    value = {
        "reads": "select count(*) from per",
        "sites_cut": f"select count(*) from {source}",
        "cuts": f"select count(*) from {source}",
        "monomers_generated": "select sum(made) from per",
        "monomers_short_removed": "select sum(made - kept) from per",
        "monomers_kept": "select sum(kept) from per",
        "reads_multi_monomer": "select count(*) from per where kept >= 2",
        "reads_lt2_monomers": "select count(*) from per where kept < 2",
        "pairs": "select count(*) from pairs",
    }
    return " union all ".join(f"select '{n}' as metric, cast(({value[n]}) as bigint) as value" for n in names)


def _with(*parts: str, select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select


_ALIGN = """
items as (
  select *, l_orderkey % (select count(*) from documents) as read_idx, case when l_returnflag = 'R' then '-' else '+' end as strand,
    ['D', 'I', 'N'][l_orderkey % 3 + 1] as op, l_linenumber * 15 as g, 100 + cast(l_quantity as bigint) * 5 as a, 100 + l_partkey % 200 as b
  from lineitem
),
placed as (
  select i.*, (l_partkey * 37 + l_linenumber * 101 + l_orderkey * 13) % (r.len - a - b - (case when op = 'I' then g else 0 end)) as q_start,
    a + b + (case when op = 'I' then g else 0 end) as qlen, row_number() over () as aln
  from items i join reads r using (read_idx) where r.len >= 1000
),
alignments as (
  select aln, cast(read_idx as bigint) as read_idx, cast(0 as bigint) as win_off, cast(q_start as bigint) as q_start, cast(q_start + qlen as bigint) as q_end,
    strand, 'hifi' || (l_suppkey % 12) as target_id,
    cast(case when strand = '+' then q_start else 200000 - q_start - qlen end + l_suppkey * 17 % 40 as bigint) as t_start,
    a || 'M' || g || op || b || 'M' as cigar
  from placed
)"""

_BLOCKS = """
ops as (
  select *, unnest(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 1)) as n_text, unnest(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 2)) as op,
    unnest(range(len(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]')))) as pos
  from alignments
),
moved as (
  select *, cast(n_text as bigint) as n, op in ('I', 'D', 'N') and cast(n_text as bigint) >= 50 as big,
    case when op in ('M', '=', 'X', 'I') then cast(n_text as bigint) else 0 end as dq, case when op in ('M', '=', 'X', 'D', 'N') then cast(n_text as bigint) else 0 end as dt
  from ops
),
summed as (
  select *, sum(cast(big as int)) over w as part, sum(dq) over w as q, sum(dt) over w as t from moved window w as (partition by aln order by pos)
),
spans as (
  select aln, part, any_value(read_idx) as read_idx, any_value(strand) as strand, any_value(target_id) as target_id, any_value(q_start) as qs, any_value(q_end) as qe,
    any_value(t_start) as ts, min(q - dq) as q0, max(q) as q1, min(t - dt) as t0, max(t) as t1
  from summed where not big group by aln, part
),
blocks as (
  select read_idx, strand, target_id, cast(case when strand = '+' then qs + q0 else qe - q1 end as bigint) as q1, cast(case when strand = '+' then qs + q1 else qe - q0 end as bigint) as q2,
    cast(ts + t0 as bigint) as t1, cast(ts + t1 as bigint) as t2
  from spans where q1 > q0
)"""

_MERGED = """
chains as (
  select read_idx, target_id, strand,
    list_reduce(
      list({s: strand, d: cast([] as struct(a bigint, b bigint)[]), c: {a: q1, b: q2, x: t1, y: t2}} order by q1, q2, t1, t2),
      lambda acc, v: case
        when v.c.a - acc.c.b < 50
          and (case when acc.s = '+' then v.c.x - acc.c.y else acc.c.x - v.c.y end) < 50
          and abs(v.c.a - acc.c.b - (case when acc.s = '+' then v.c.x - acc.c.y else acc.c.x - v.c.y end)) < 50
        then {s: acc.s, d: acc.d, c: {a: acc.c.a, b: greatest(acc.c.b, v.c.b),
          x: case when acc.s = '+' then acc.c.x else least(acc.c.x, v.c.x) end, y: case when acc.s = '+' then greatest(acc.c.y, v.c.y) else acc.c.y end}}
        else {s: acc.s, d: list_append(acc.d, {a: acc.c.a, b: acc.c.b}), c: v.c} end
    ) as r
  from blocks group by read_idx, target_id, strand
),
merged as (
  select read_idx, m.a as q_start, m.b as q_end, target_id from (
    select read_idx, target_id, unnest(list_append(r.d, {a: r.c.a, b: r.c.b})) as m from chains
  )
)"""

_FINAL = """
sites_final as (
  select s.*, cast((
    select count(distinct target_id) from merged b where b.read_idx = s.read_idx and b.q_start <= greatest(0, s.x - 15) and b.q_end >= least(s.len, s.x + 15)
  ) as bigint) as span from sites s
),
classed as (select *, case when span >= 3 then 'P' else 'C' end as class from sites_final),
cut_sites as (select * from classed where class = 'C')"""

_OFFS = """
offs as (
  select read_idx, seq, unnest(case when len <= 2000 then [cast(0 as bigint)] else list_append(list_filter(range(0, len, 1750), lambda s: s + 2000 < len), len - 2000) end) as win_off from reads
)"""

_SEEDS = f"""
kmers as (
  select read_idx, cast(i as bigint) as pos, substr(seq, i + 1, {seeds.K}) as kmer from (select read_idx, seq, unnest(range(0, greatest(len - {seeds.K - 1}, 0))) as i from reads)
),
coded as (
  select read_idx, pos, cast(translate(kmer, 'ACGT', '0123') as bigint) as f, cast(reverse(translate(kmer, 'ACGT', '3210')) as bigint) as b from kmers
),
hashed as (
  select read_idx, pos, least(f, b) as seed, b < f as reverse, f = b as none, count(*) over (partition by read_idx) as n,
    case when f = b then 9223372036854775807 else (least(f, b) // 100000000 * {seeds.HIGH} + least(f, b) % 100000000 * {seeds.LOW}) % {seeds.PRIME} end as h
  from coded
),
lowest as (
  select *, case when pos + least({seeds.W}, n) <= n then min(h) over (partition by read_idx order by pos rows between current row and {seeds.W - 1} following) end as m from hashed
),
best as (select *, max(m) over (partition by read_idx order by pos rows between {seeds.W - 1} preceding and current row) as most from lowest),
minimizers as (select read_idx, pos, seed, reverse from best where most = h and not none)"""

_HITS = f"""
occs as (select seed, count(*) as occ from minimizers group by seed),
often as (select occ, sum(n) over (order by occ desc) as above from (select occ, count(*) as n from occs group by occ)),
mask as (select greatest(10, coalesce(max(occ), 0)) as most from often where above > {seeds.MASKED} * (select count(*) from occs)),
hits as (
  select q.read_idx, t.read_idx as target_idx, q.reverse <> t.reverse as reverse, q.pos as q_pos, t.pos as t_pos
  from minimizers q join minimizers t on q.seed = t.seed and q.read_idx <> t.read_idx join occs o on o.seed = q.seed where o.occ <= (select most from mask)
)"""

_CATG = _sites_sql("CATG", 4, False)
_PLAIN = (_READS, _CATG, _cut_sql("x", "x", 30))
_DUP = (_READS, _CATG, _cut_sql("motif_start", "motif_end", 20))
_GUIDED = (_READS, _sites_sql("CATG", 4, True), _ALIGN, _BLOCKS, _MERGED, _FINAL)
_GUIDED_CUT = (*_GUIDED, _cut_sql("motif_start", "motif_end", 20, "cut_sites"))
_ALL_SITES = "select read_idx, len, motif_start, motif_end, x from sites"
_MONOMER_ROWS = 'select read_idx, rank, beg, "end", md5(seq) as seq from monomers'
_PAIR_ROWS = "select read_idx, i, j, md5(r1_seq) as r1_seq, md5(r2_seq) as r2_seq from pairs"
_RECORD = "'@read' || read_idx || {name} || chr(10) || {seq} || chr(10) || '+' || chr(10) || repeat('I', length({seq}))"
_SITE_ROWS = "select read_idx, len, motif_start, motif_end, x, span, class from classed"

ORACLE_SQL: dict[str, str] = {
    "reads": _with(_READS, select="select read_idx, 'read' || read_idx as read_id, md5(seq) as seq, len, md5(repeat('I', len)) as qual from reads"),
    "genome_stats": _with(_READS, select="select count(*) as reads, cast(sum(len) as bigint) as bases, round(sum(len) / count(*), 1) as mean_len from reads"),
    "reverse_complements": _with(_READS, select="select read_idx, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) as rc from reads"),
    "digest_sites": _with(_READS, _CATG, select=_ALL_SITES),
    "interior_sites": _with(_READS, _sites_sql("CATG", 4, True), select=_ALL_SITES),
    "iupac_sites": _with(_READS, _sites_sql("GANTC", 1, False), select=_ALL_SITES),
    "overlapping_sites": _with(_READS, _sites_sql("CGCG", 2, False), select=_ALL_SITES),
    "windows": _with(
        _READS,
        _OFFS,
        select="select read_idx, win_off, md5(substr(seq, win_off + 1, 2000)) as win_seq from offs",
    ),
    "window_records": _with(
        _READS,
        _OFFS,
        select="select read_idx, md5('>read' || read_idx || '_W' || win_off || chr(10) || substr(seq, win_off + 1, 2000)) as record from offs",
    ),
    "digest_monomers": _with(*_PLAIN, select=_MONOMER_ROWS),
    "digest_monomers_dup": _with(*_DUP, select=_MONOMER_ROWS),
    "digest_pairs_all": _with(*_PLAIN, _pairs_sql("all"), select=_PAIR_ROWS),
    "digest_pairs_seq": _with(*_PLAIN, _pairs_sql("seq"), select=_PAIR_ROWS),
    "digest_pairs_dup": _with(*_DUP, _pairs_sql("all"), select=_PAIR_ROWS),
    "digest_stats": _with(*_PLAIN, _pairs_sql("all"), _COUNTS, select=_stats_sql(stats.DIGEST)),
    "digest_stats_dup_seq": _with(*_DUP, _pairs_sql("seq"), _COUNTS, select=_stats_sql(stats.DIGEST)),
    "digest_stats_stream": _with(*_PLAIN, _pairs_sql("all"), _COUNTS, select=_stats_sql(stats.DIGEST)),
    "monomers_per_read": _with(
        *_PLAIN, _COUNTS, select="select count(*) as reads, cast(sum(kept) as bigint) as kept, round(sum(kept) / count(*), 2) as monomers_per_read from per"
    ),
    "pair_records": _with(
        *_PLAIN,
        _pairs_sql("all"),
        select=" union all ".join(
            f"select read_idx, md5({_RECORD.format(name=f"':' || i || '-' || j || '/{k}'", seq=f'r{k}_seq')}) as record from pairs" for k in (1, 2)
        ),
    ),
    "monomer_records": _with(*_PLAIN, select=f"""select read_idx, md5({_RECORD.format(name="'_' || beg || '_' || \"end\"", seq="seq")}) as record from monomers"""),
    "alignments": _with(_READS, _ALIGN, select="select read_idx, win_off, q_start, q_end, strand, target_id, t_start, cigar from alignments"),
    "cigar_blocks": _with(_READS, _ALIGN, _BLOCKS, select="select read_idx, strand, target_id, q1, q2, t1, t2 from blocks"),
    "paf_blocks": _with(
        _READS,
        _ALIGN,
        _BLOCKS.replace("from alignments", "from alignments where t_start % 3 <> 0"),
        select="""select read_idx, strand, target_id, q1, q2, t1, t2 from blocks union all
select read_idx, strand, target_id, q_start, q_end, t_start,
  t_start + cast(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN]', 1), lambda x: cast(x as bigint))) as bigint)
from alignments where t_start % 3 = 0""",
    ),
    "fastq_files": _with(_READS, select="select 'read' || read_idx as read_id, md5(seq) as seq, len, md5(repeat('I', len)) as qual from reads"),
    "fastq_multiline": _with(
        _READS, select="select 'read' || read_idx as read_id, md5(seq) as seq, len, md5(regexp_replace(repeat('I', len), '(.{61}).{2}', '\\1@+', 'g')) as qual from reads"
    ),
    "fastq_source": _with(_READS, select="select 'read' || read_idx as read_id, md5(seq) as seq from reads"),
    "fastq_stream": _with(*_PLAIN, _pairs_sql("all"), _COUNTS, select=_stats_sql(stats.DIGEST)),
    "fasta_files": _with(_READS, select="select 'read' || read_idx as read_id, md5(seq) as seq, len from reads"),
    "pair_files": _with(
        *_PLAIN,
        _pairs_sql("all"),
        select=" union all ".join(
            f"select 'read' || read_idx || ':' || i || '-' || j || '/{k}' as read_id, md5(r{k}_seq) as seq, cast(length(r{k}_seq) as bigint) as len from pairs" for k in (1, 2)
        ),
    ),
    "monomer_files": _with(*_PLAIN, select="""select 'read' || read_idx || '_' || beg || '_' || "end" as read_id, md5(seq) as seq, "end" - beg as len from monomers"""),
    "window_files": _with(
        _READS, _OFFS, select="select 'read' || read_idx || '_W' || win_off as read_id, md5(substr(seq, win_off + 1, 2000)) as seq, cast(length(substr(seq, win_off + 1, 2000)) as bigint) as len from offs"
    ),
    "sites_file": _with(*_GUIDED, select=_SITE_ROWS),
    "stats_file": _with(*_PLAIN, _pairs_sql("all"), _COUNTS, select=_stats_sql(stats.DIGEST)),
    "resumed_sites": _with(_READS, _sites_sql("CATG", 4, True), select=_ALL_SITES),
    "stage_counts": _with(_READS, _OFFS, select="select 'reads' as name, count(*) as value from reads union all select 'windows', count(*) from offs"),
    "merged_blocks": _with(_READS, _ALIGN, _BLOCKS, _MERGED, select="select read_idx, q_start, q_end, target_id from merged"),
    "reads_with_blocks": _with(_READS, _ALIGN, _BLOCKS, _MERGED, select="select count(distinct read_idx) as reads, count(*) as blocks from merged"),
    "sites_final": _with(*_GUIDED, select=_SITE_ROWS),
    "sites_final_binned": _with(*_GUIDED, select=_SITE_ROWS),
    "sites_final_sweep": _with(*_GUIDED, select=_SITE_ROWS),
    "span_histogram": _with(*_GUIDED, select="select span, count(*) as n_sites from classed group by span"),
    "class_summary": _with(
        *_GUIDED,
        select="""select sites, protected, cut, round(protected * 100.0 / sites, 1) as pct_protected, round(cut * 100.0 / sites, 1) as pct_cut
from (select count(*) as sites, count(*) filter (class = 'P') as protected, count(*) filter (class = 'C') as cut from classed)""",
    ),
    "guided_monomers": _with(*_GUIDED_CUT, select=_MONOMER_ROWS),
    "guided_pairs": _with(*_GUIDED_CUT, _pairs_sql("all"), select=_PAIR_ROWS),
    "guided_stats": _with(*_GUIDED_CUT, _pairs_sql("all"), _COUNTS, select=_stats_sql(stats.GUIDED, "cut_sites")),
    "guided_bucketed": _with(*_GUIDED_CUT, _pairs_sql("all"), select=_PAIR_ROWS),
    "digest_observed_stats": _with(*_PLAIN, _pairs_sql("all"), _COUNTS, select=_stats_sql(stats.DIGEST)),
    "chunk_list": _with(
        *_PLAIN,
        _pairs_sql("all"),
        select="select 'read' || read_idx || ':' || i || '-' || j as name, md5(r1_seq) as r1_seq, md5(r2_seq) as r2_seq, (select count(*) from pairs) as listed from pairs",
    ),
    "minimizers": _with(_READS, _SEEDS, select="select read_idx, pos, seed, reverse from minimizers"),
    "seed_hits": _with(_READS, _SEEDS, _HITS, select="select read_idx, target_idx, reverse, q_pos, t_pos from hits"),
    "guided_problems": _with(
        *_GUIDED_CUT,
        select="""select 'sites_of_unknown_reads' as problem, (select count(*) from classed where read_idx not in (select read_idx from reads)) as n
union all select 'cuts_not_applied', (select count(*) from cut_sites) - (select count(*) from marks)
union all select 'repeated_sites', (select count(*) from (select 1 from classed group by read_idx, motif_start having count(*) > 1))""",
    ),
}
