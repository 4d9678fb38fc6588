"""Hand-made cases of the read operators, random reads against plain loops, files and streams."""

import gzip
import random
import re
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandloom import cli
from strandloom.config import DigestConfig, GuidedConfig, from_environment
from strandloom.functions.motif import check_motif, motif_starts, reverse_complement
from strandloom.operators.cigar import split_alignments
from strandloom.operators.merge import merge_blocks
from strandloom.operators.protect import class_summary, protect, protect_sweep
from strandloom.operators.stats import DIGEST, observed_metrics
from strandloom.operators.windows import split_windows
from strandloom.plans.digest import Digest
from strandloom.plans.guided import Guided, bucketed_guided
from strandloom.plans.manifest import Manifest, clock
from strandloom.sources import fastq_source, sinks
from strandloom.sources.fastq import read_fasta, read_fastq, stream_fastq, total_bases
from strandloom.sources.fastq_chunks import chunk_lists, read_chunk_list, write_chunks
from strandloom.sources.paf import on_reads, read_paf
from strandloom.streaming.digest_stream import stream_pairs

ALIGN = "read_idx bigint, win_off bigint, q_start bigint, q_end bigint, strand string, target_id string, t_start bigint, cigar string"


def reads(spark, *seqs):
    rows = [(i, f"r{i}", s, "I" * len(s), len(s)) for i, s in enumerate(seqs)]
    return spark.createDataFrame(rows, "read_idx bigint, read_id string, seq string, qual string, len bigint")


def metrics(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def spans(df):
    return [(r["beg"], r["end"]) for r in df.orderBy("read_idx", "rank").collect()]


def test_motifs():
    assert check_motif("gantc") == "GANTC"
    assert reverse_complement("RGATCY") == "RGATCY"
    for bad in ("", "AAC", "CAXG"):
        with pytest.raises(ValueError):
            check_motif(bad)
    with pytest.raises(ValueError):
        DigestConfig(cut_offset=5)
    with pytest.raises(ValueError):
        DigestConfig(pair_mode="some")
    with pytest.raises(ValueError):
        GuidedConfig(window_overlap=20)
    assert GuidedConfig().min_mono_len == 20
    c = from_environment(DigestConfig, {"MOTIF": "gatc", "CUT_OFFSET": "0", "DUP_MOTIF": "1", "PAIR_MODE": "seq", "MIN_MONO_LEN": ""})
    assert (c.motif, c.cut_offset, c.dup_motif, c.pair_mode, c.min_mono_len) == ("GATC", 0, True, "seq", 30)


@pytest.mark.parametrize(
    "seq, options, want, sites, pairs",
    [
        ("AACATGTTTTCATGGG", {"min_mono_len": 3}, [(0, 6), (6, 14)], 2, 1),
        ("AACATGTTTTCATGGG", {"min_mono_len": 3, "dup_motif": True}, [(0, 6), (2, 14), (10, 16)], 2, 3),
        ("AACATGTTTTCATGGG", {"min_mono_len": 3, "dup_motif": True, "pair_mode": "seq"}, [(0, 6), (2, 14), (10, 16)], 2, 2),
        ("AACATG", {"min_mono_len": 1}, [(0, 6)], 1, 0),
        ("AACATG", {"min_mono_len": 1, "dup_motif": True}, [(0, 6), (2, 6)], 1, 1),
        ("CATGAA", {"min_mono_len": 1, "cut_offset": 0}, [(0, 6)], 1, 0),
        ("", {}, [], 0, 0),
        ("TTTTTTCATGCATGTTTTTT", {"min_mono_len": 5, "pair_mode": "seq"}, [(0, 10), (14, 20)], 2, 1),
    ],
)
def test_digest_by_hand(spark, seq, options, want, sites, pairs):
    d = Digest(reads(spark, seq), DigestConfig(**options))
    m = metrics(d.stats)
    assert spans(d.monomers) == want
    assert (m["sites_cut"], m["pairs"], m["monomers_kept"]) == (sites, pairs, len(want))
    assert m["reads_lt2_monomers"] == (len(want) < 2) and d.pairs.count() == pairs


def test_overlap_and_case(spark):
    def found(seq, motif, **options):
        return reads(spark, seq).select(motif_starts(F.col("seq"), motif, **options).alias("x")).first()["x"]

    assert found("CGCGCG", "CGCG") == [0]
    assert found("CGCGCGACGCG", "CGCG", overlap=True) == [0, 2, 7]
    assert found("aacatgCATG", "CATG") == [6]
    assert found("aacatgCATG", "CATG", case_sensitive=False) == [2, 6]
    assert found("CANTG", "CANNTG") == []


def loop(seq, dup, offset, least):
    at = [m.start() for m in re.finditer("CATG", seq)]
    begs = [0] + [s if dup else s + offset for s in at]
    ends = [s + 4 if dup else s + offset for s in at] + [len(seq)]
    return [(b, e) for b, e in zip(begs, ends) if e > b and e - b >= least]


@pytest.mark.parametrize("dup", [False, True])
def test_random_reads(spark, dup):
    rng = random.Random(3)
    seqs = ["".join(rng.choice(["A", "C", "G", "T", "CATG"]) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    d = Digest(reads(spark, *seqs), DigestConfig(dup_motif=dup, min_mono_len=6))
    want = [loop(s, dup, 4, 6) for s in seqs]
    got = [[] for _ in seqs]
    for r in d.monomers.orderBy("read_idx", "rank").collect():
        got[r["read_idx"]].append((r["beg"], r["end"]))
        assert r["seq"] == seqs[r["read_idx"]][r["beg"] : r["end"]] and len(r["qual"]) == len(r["seq"])
    assert got == want
    pairs = sorted((r["read_idx"], r["i"], r["j"], r["r1_seq"], r["r2_seq"]) for r in d.pairs.collect())
    assert pairs == sorted((n, i + 1, j + 1, seqs[n][w[i][0] : w[i][1]], seqs[n][w[j][0] : w[j][1]]) for n, w in enumerate(want) for i in range(len(w)) for j in range(i + 1, len(w)))
    assert metrics(d.stats)["pairs"] == len(pairs)


def test_whole_reads_come_back_from_monomers(spark):
    seqs = ["AACATGTTTTCATGGG", "CATGCATG", "TTT"]
    m = Digest(reads(spark, *seqs), DigestConfig(min_mono_len=1)).monomers.orderBy("read_idx", "rank").collect()
    assert ["".join(r["seq"] for r in m if r["read_idx"] == i) for i in range(3)] == seqs


@pytest.mark.parametrize("length, want", [(2000, [0]), (2001, [0, 1]), (3750, [0, 1750]), (5000, [0, 1750, 3000]), (0, [0])])
def test_windows(spark, length, want):
    got = split_windows(reads(spark, "A" * length)).orderBy("win_off").collect()
    assert [r["win_off"] for r in got] == want and all(len(r["win_seq"]) == min(2000, length) for r in got)


@pytest.mark.parametrize("strand, want", [("+", [(100, 200, 1000, 1100), (200, 400, 1160, 1340)]), ("-", [(100, 300, 1160, 1340), (300, 400, 1000, 1100)])])
def test_cigar(spark, strand, want):
    rows = [(1, 0, 100, 400, strand, "t", 1000, "100M60D100M20I80M"), (2, 0, 0, 5, strand, "t", 0, "5S"), (3, 0, 0, 5, strand, "t", 0, "")]
    got = split_alignments(spark.createDataFrame(rows, ALIGN), 50).orderBy("q1").collect()
    assert [tuple(r[c] for c in ("q1", "q2", "t1", "t2")) for r in got] == want


BLOCK = "read_idx bigint, strand string, target_id string, q1 bigint, q2 bigint, t1 bigint, t2 bigint"


def merge_loop(rows, gap):
    out, groups = [], {}
    for r in rows:
        groups.setdefault((r[0], r[2], r[1]), []).append(list(r[3:]))
    for (read, target, strand), g in groups.items():
        g.sort()
        p = g[0]
        for q1, q2, t1, t2 in g[1:]:
            gq, gt = q1 - p[1], (t1 - p[3] if strand == "+" else p[2] - t2)
            if gq < gap and gt < gap and abs(gq - gt) < gap:
                p = [p[0], max(p[1], q2), p[2] if strand == "+" else min(p[2], t1), max(p[3], t2) if strand == "+" else p[3]]
            else:
                out.append((read, p[0], p[1], target))
                p = [q1, q2, t1, t2]
        out.append((read, p[0], p[1], target))
    return sorted(out)


def test_merge(spark):
    nested = [(1, "+", "a", 0, 500, 0, 500), (1, "+", "a", 10, 60, 10, 60), (1, "+", "a", 510, 600, 510, 600)]
    reset = [(2, "+", "a", 0, 100, 5000, 5100), (2, "+", "a", 200, 300, 0, 100), (2, "+", "a", 310, 400, 110, 200)]
    got = sorted(map(tuple, merge_blocks(spark.createDataFrame(nested + reset, BLOCK)).collect()))
    assert got == [(1, 0, 600, "a"), (2, 0, 100, "a"), (2, 200, 400, "a")]
    rng = random.Random(5)
    rows = []
    for read in range(60):
        for _ in range(rng.randint(1, 14)):
            q, n, t = rng.randint(0, 400), rng.randint(1, 120), rng.randint(0, 400)
            rows.append((read, rng.choice("+-"), rng.choice("ab"), q, q + n, t, t + n))
    assert sorted(map(tuple, merge_blocks(spark.createDataFrame(rows, BLOCK)).collect())) == merge_loop(rows, 50)


@pytest.mark.parametrize("bin_size", [None, 64])
def test_protect(spark, bin_size):
    sites = spark.createDataFrame([(1, 1000, 496, 500, 500), (1, 1000, 1, 5, 5), (2, 100, 40, 44, 44)], "read_idx bigint, len bigint, motif_start bigint, motif_end bigint, x bigint")
    rows = [(1, 485, 515, "a"), (1, 400, 600, "b"), (1, 450, 514, "c"), (1, 0, 20, "a"), (1, 480, 520, "b"), (1, 0, 19, "b"), (1, 100, 900, "d")]
    final = protect(sites, spark.createDataFrame(rows, "read_idx bigint, q_start bigint, q_end bigint, target_id string"), bin_size=bin_size)
    assert {(r["read_idx"], r["x"]): (r["span"], r["class"]) for r in final.collect()} == {(1, 500): (3, "P"), (1, 5): (1, "C"), (2, 44): (0, "C")}
    assert class_summary(final).first().asDict() == {"sites": 3, "protected": 1, "cut": 2, "pct_protected": 33.3, "pct_cut": 66.7}
    assert class_summary(final.limit(0)).first()["pct_cut"] == 0


def test_sweep_equals_join(spark):
    rng = random.Random(8)
    sites, blocks = [], []
    for read in range(40):
        n = rng.choice([5, 20, 60, 200])
        for x in sorted(rng.sample(range(n + 1), rng.randint(0, min(n, 12)))):
            sites.append((read, n, x - 4, x, x))
        for _ in range(rng.choice([0, 3, 60])):
            a = rng.choice([0, rng.randint(-2, n)])
            blocks.append((read, a, rng.choice([n, n + 3, rng.randint(a, n + 2)]), rng.choice("abcd")))
    s = spark.createDataFrame(sites, "read_idx bigint, len bigint, motif_start bigint, motif_end bigint, x bigint")
    b = spark.createDataFrame(blocks, "read_idx bigint, q_start bigint, q_end bigint, target_id string")
    for flank in (0, 3, 15, 70):
        want, got = protect(s, b, flank, 2), protect_sweep(s, b, flank, 2)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = protect_sweep(s, b)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # blocks with the length of their read; none with sites


def test_guided_without_support(spark):
    seqs = ["AACATG", "CATGAA", "AACATGTTTTCATGGG", "TTT"]
    none = spark.createDataFrame([], ALIGN)
    g = Guided(reads(spark, *seqs), none, GuidedConfig(dup_motif=False, min_mono_len=1))
    d = Digest(reads(spark, *seqs), DigestConfig(min_mono_len=1))
    assert spans(g.monomers) == spans(d.monomers)
    assert metrics(g.stats)["cuts"] == 3 and metrics(d.stats)["sites_cut"] == 4
    assert all(r["n"] == 0 for r in g.problems().collect())


def test_fastq_files(spark, tmp_path):
    seqs = ["ACGT" * 30, "GGCATGAA", "", "TTTT"]
    text = "".join(f"@r{i} more\tx\n{s}\n+\n{'@' * len(s)}\n" for i, s in enumerate(seqs))
    (tmp_path / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    got = read_fastq(spark, str(tmp_path / "*.fastq*"), range_bytes=50).orderBy("read_idx").collect()  # borders cut records
    assert [(r["read_id"], r["seq"], r["qual"], r["len"]) for r in got] == [(f"r{i}", s, "@" * len(s), len(s)) for i, s in enumerate(seqs)] * 2
    for name, bad in (("bad", "@r\nACGT\n+\nII\n"), ("short", "@r\nACGT\n+\n"), ("open", "@r\nACGT\n"), ("none", "ACGT\n"), ("long", "@r\nAC\n+\nIII\n"), ("behind", "@r\nAC\n+\nII\nAC\n")):
        (tmp_path / f"{name}.fastq").write_text(bad)
        with pytest.raises(Exception, match="BrokenRecord"):
            read_fastq(spark, str(tmp_path / f"{name}.fastq")).collect()
    with pytest.raises(Exception, match="nothing.fastq"):
        read_fastq(spark, str(tmp_path / "nothing.fastq")).collect()


def wrapped_records(rng, n, longest=400):
    """(text, [(id, seq, qual)]): records whose sequences and qualities have lines of different lengths, with line starts like headers and separators."""

    def lines(x):
        out = []
        while x:
            k = rng.choice([1, 7, 60, 61])
            out.append(x[:k])
            x = x[k:]
        return out or [""]

    text, want = "", []
    for i in range(n):
        size = rng.choice([0, 1, rng.randint(2, longest), rng.randint(2, 40)])
        seq, qual = "".join(rng.choices("ACGTN", k=size)), "".join(rng.choices("@+I#", k=size))
        own = [f"@r{i} x"] + (lines(seq) if i % 3 else [seq]) + [rng.choice(["+", f"+r{i}"])] + (lines(qual) if i % 3 else [qual])
        text += rng.choice(["\n", "\n", "\r\n"]).join(own) + "\n" * rng.choice([1, 1, 1, 2])
        want.append((f"r{i}", seq, qual))
    return text, want


@pytest.mark.parametrize("seed", range(4))
def test_fastq_of_many_lines(tmp_path, monkeypatch, seed):
    monkeypatch.setattr(fastq_source, "LOOK", 300)
    monkeypatch.setattr(fastq_source, "STEP", 700)
    rng = random.Random(seed)
    text, want = wrapped_records(rng, 150)
    text = text if seed % 2 else text.rstrip("\n") + "I" * 0
    (tmp_path / "x.fastq").write_bytes(text.encode())
    seen = []
    for span in (10**9, 1000, 97):
        reader = fastq_source._BatchReader(StructType.fromDDL(fastq_source.SCHEMA), str(tmp_path), span)
        rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["read_id"], r["seq"], r["qual"]) for r in rows] == want and all(r["len"] == len(r["seq"]) for r in rows)
        seen.append([r["read_idx"] for r in rows])
    assert seen[0] == seen[1] == seen[2] == sorted(set(seen[0]))


@pytest.mark.parametrize("width", [0, 60])
def test_fastq_ranges_read_little_more_than_their_own(tmp_path, monkeypatch, width):
    """A range isn't followed from the file's start, also where qualities look like headers and separators."""
    monkeypatch.setattr(fastq_source, "LOOK", 4096)
    rng = random.Random(5)
    rows, text = [], []
    for i in range(400):
        seq = "".join(rng.choices("ACGT", k=rng.randint(0, 3000)))
        qual = re.sub("(.{61}).{2}", r"\1@+", "I" * len(seq))
        lines = [re.sub(f"(.{{{w}}})(?=.)", r"\1\n", x) if width else x for x, w in ((seq, width), (qual, width + 1))]
        rows.append((f"r{i}", seq, qual))
        text.append(f"@r{i}\n{lines[0]}\n+\n{lines[1]}\n")
    (tmp_path / "x.fastq").write_text("".join(text))
    size, read = (tmp_path / "x.fastq").stat().st_size, []

    class Counted:
        def __init__(self, file):
            self.file, self.seek = file, file.seek

        def read(self, n):
            read.append(n)
            return self.file.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

    class System:
        def open_input_file(self, place):
            return Counted(open(place, "rb"))

    monkeypatch.setattr(fastq_source, "open_path", lambda uri: (System(), uri))
    own = fastq_source._Reads(StructType([StructField(c, StringType()) for c in ("read_id", "seq", "qual")]))
    cuts = [*range(0, size, 30_000), size]
    got = [tuple(r.values()) for a, b in zip(cuts, cuts[1:]) for x in own.read(fastq_source.Range(str(tmp_path / "x.fastq"), 0, size, a, b)) for r in x.to_pylist()]
    assert got == rows and sum(read) < 12 * size


def test_fastq_broken_in_any_place_fails(tmp_path, monkeypatch):
    monkeypatch.setattr(fastq_source, "LOOK", 300)
    rng = random.Random(9)
    text, _ = wrapped_records(rng, 120)
    places = [m.start() for m in re.finditer("[ACGT]", text)]
    for at in rng.sample(places, 25):
        (tmp_path / "x.fastq").write_text(text[:at] + text[at + 1 :])  # a sequence is one letter short
        reader = fastq_source._BatchReader(StructType.fromDDL(fastq_source.SCHEMA), str(tmp_path), 500)
        with pytest.raises(fastq_source.BrokenRecord):
            for p in reader.partitions():
                list(reader.read(p))


def test_fastq_source_columns_and_stream(spark, tmp_path):
    fastq_source.register(spark)
    one = spark.read.format("fastq").schema("seq string, read_idx bigint")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fastq").write_text("@a\nAACATGTTTTCATGGG\n+\n" + "I" * 16 + "\n")
    assert [tuple(r) for r in one.load(str(tmp_path / "in")).collect()] == [("AACATGTTTTCATGGG", 0)]
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("fastq").schema("bases string").load(str(tmp_path / "in")).collect()
    (tmp_path / "empty").mkdir()
    assert read_fastq(spark, str(tmp_path / "empty")).count() == 0
    for k in (1, 2):  # the second run goes on behind the first one's files
        query = stream_pairs(stream_fastq(spark, str(tmp_path / "in")), DigestConfig(min_mono_len=3), str(tmp_path / "pairs"), str(tmp_path / "state"))
        query.processAllAvailable()
        query.stop()
        assert spark.read.parquet(str(tmp_path / "pairs")).count() == k
        (tmp_path / "in" / "b.fastq").write_text("@b\nTTCATGTTTTTT\n+\n" + "I" * 12 + "\n")


def test_fasta_and_paf(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one\nACG\nT\n>b\nGG\n")
    fasta = read_fasta(spark, str(tmp_path / "x.fa"))
    assert sorted((r["read_id"], r["seq"]) for r in fasta.collect()) == [("a", "ACGT"), ("b", "GG")] and total_bases(fasta) == 6
    line = "a_W1750\t2000\t10\t20\t-\thifi1\t900\t5\t15\t10\t10\t60\ttp:A:P\tcg:Z:10M\n"
    (tmp_path / "x.paf").write_text(line + line.replace("cg:Z:10M", "zz:Z:1"))
    row, plain = on_reads(read_paf(spark, str(tmp_path / "x.paf")), reads(spark, "A").withColumn("read_id", F.lit("a"))).orderBy(F.col("cigar").isNull()).collect()
    assert (row["read_idx"], row["win_off"], row["q_start"], row["strand"], row["target_id"], row["t_start"], row["cigar"]) == (0, 1750, 10, "-", "hifi1", 5, "10M")
    assert (plain["cigar"], plain["t_end"]) == (None, 15)


def test_alignments_without_cigar(spark):
    rows = [(0, 100, 10, 30, "-", "h", 5, 26, None), (0, 0, 10, 30, "+", "h", 5, 26, ""), (0, 0, 7, 7, "+", "h", 5, 5, None), (0, 0, 0, 20, "-", "h", 0, 80, "5S10=60N2X3P8=4H")]
    df = spark.createDataFrame(rows, ALIGN.replace("cigar", "t_end bigint, cigar"))
    assert sorted((r["q1"], r["q2"], r["t1"], r["t2"]) for r in split_alignments(df, 50).collect()) == [(0, 10, 70, 80), (10, 20, 0, 10), (10, 30, 5, 26), (110, 130, 5, 26)]


def test_many_operations_and_many_blocks_take_linear_time(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        ops = [(rng.choice([1, 3, 49, 50, 51, 700]), rng.choice("MIDNSHP=X")) for _ in range(rng.randint(0, 12))]
        n = sum(k for k, o in ops if o in "M=XI")
        rows.append((i, 5, 100, 100 + n, rng.choice("+-"), "h", 1000, "".join(f"{k}{o}" for k, o in ops) or "7H"))
    rows.append((300, 0, 0, 200_000, "+", "h", 0, "1M60D" * 200_000))
    began = time.time()
    got = sorted((r["read_idx"], r["q1"], r["q2"], r["t1"], r["t2"]) for r in split_alignments(spark.createDataFrame(rows, ALIGN), 50).collect())
    want = []
    for i, off, a, b, strand, _, t, cigar in rows:
        q0 = t0 = q = p = 0
        for k, o in [(int(k), o) for k, o in re.findall(r"(\d+)([A-Z=])", cigar)] + [(50, "D")]:
            if o in "IDN" and k >= 50:
                if q > q0:
                    want.append((i, off + a + q0, off + a + q, t + t0, t + p) if strand == "+" else (i, off + b - q, off + b - q0, t + t0, t + p))
            q, p = q + k * (o in "M=XI"), p + k * (o in "M=XDN")
            if o in "IDN" and k >= 50:
                q0, t0 = q, p
    assert got == sorted(want)
    many = [(1, "+", "a", 100 * i, 100 * i + 90, 100 * i, 100 * i + 90) for i in range(100_000)]
    merged = merge_blocks(spark.createDataFrame(many, BLOCK)).collect()
    assert [tuple(r) for r in merged] == [(1, 0, 9_999_990, "a")] and time.time() - began < 60


def test_digest_plans_work_each_expression_out_once(spark):
    d = Digest(reads(spark, "AACATGTTTTCATGGG"), DigestConfig(min_mono_len=3))
    for df in (d.monomers, d.pairs):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") <= 2 and plan.count("aggregate(") <= 2


def test_outputs(spark, tmp_path):
    d = Digest(reads(spark, "AACATGTTTTCATGGG", "TTT"), DigestConfig(min_mono_len=3, dup_motif=True))
    sinks.write_pairs(d.pairs, str(tmp_path / "pairs"))
    sides = [[gzip.open(f, "rt").read() for f in sorted((tmp_path / "pairs" / f"side={k}").glob("*.gz"))] for k in (1, 2)]
    one, two = ("".join(s).split("\n") for s in sides)
    assert one[0::4][:3] == ["@r0:1-2/1", "@r0:1-3/1", "@r0:2-3/1"] and two[0::4][:3] == [x[:-1] + "2" for x in one[0::4][:3]]
    assert one[1] == "AACATG" and two[1] == "CATGTTTTCATG"
    sinks.write_pairs(d.pairs.limit(0), str(tmp_path / "none"))
    sinks.write_stats(d.stats, str(tmp_path / "stats"))
    sinks.write_stats(d.stats, str(tmp_path / "line"), labelled=False)
    assert spark.read.text(str(tmp_path / "line")).first()[0] == "2 2 4 0 4 1 1 3"
    sinks.write_monomers(d.monomers, str(tmp_path / "m"))
    assert "@r0_2_14" in spark.read.text(str(tmp_path / "m")).toPandas()["value"].tolist()


def test_manifest(spark, tmp_path):
    runs = []

    def make(name):
        def run():
            runs.append(name)
            return spark.range(3)

        return run

    def go(**options):
        m = Manifest(spark, str(tmp_path / "m"))
        m.stage("one", make("one"), **options)
        m.stage("two", make("two"))
        return m

    assert go().count("two") == 3 and runs == ["one", "two"]
    go()
    assert runs == ["one", "two"]
    go(flank=3)
    assert runs == ["one", "two"] * 2


def test_manifest_values(spark, tmp_path):
    m = Manifest(spark, str(tmp_path / "m"))
    assert m.get("mid_occ") is None and m.get("mid_occ", 10) == 10
    m.put("mid_occ", 12)
    m.put("mid_occ", {"at": [13]})
    assert Manifest(spark, str(tmp_path / "m")).get("mid_occ") == {"at": [13]}
    m.forget("mid_occ")
    assert m.get("mid_occ", "none") == "none"
    assert m.counted("reads", lambda: spark.range(7)) == 7 and m.counted("reads", lambda: spark.range(8)) == 7
    m.stage("new", lambda: spark.range(1))  # what was counted before may be of an older run
    assert m.counted("reads", lambda: spark.range(8)) == 8


@pytest.mark.parametrize("n", [1, 255, 256, 257, 700])
def test_many_sites(spark, n):
    got = reads(spark, "TT" + "CATGA" * n).select(motif_starts(F.col("seq"), "CATG").alias("x")).first()["x"]
    assert got == [2 + 5 * i for i in range(n)]


def test_null_sequence_has_no_places(spark):
    assert spark.sql("select cast(null as string) as seq").select(motif_starts(F.col("seq"), "CATG").alias("x")).first()["x"] is None


def test_command_line(spark, tmp_path, monkeypatch):
    seq = "A" * 30 + "CATG" + "T" * 40 + "CATG" + "G" * 30
    (tmp_path / "r.fastq").write_text(f"@a x\n{seq}\n+\n{'I' * len(seq)}\n@b\nTTT\n+\nIII\n")
    (tmp_path / "r.paf").write_text("".join(f"a\t{len(seq)}\t10\t60\t+\th{k}\t900\t10\t60\t50\t50\t60\tcg:Z:50M\n" for k in range(3)))
    monkeypatch.setenv("WRITE_MONOMERS", "1")
    out = tmp_path / "digest"
    for _ in range(2):  # the second run takes up the first one's cuts
        cli.main(["digest", str(tmp_path / "r.fastq"), str(out)])
        monomers = read_fastq(spark, str(out / "monomers"))
        assert sorted(r["read_id"] for r in monomers.collect()) == ["a_0_34", "a_34_78", "a_78_108"]
    assert spark.read.csv(str(out / "stats"), sep="\t", header=True).where("metric = 'pairs'").first()["value"] == "3"
    out = tmp_path / "guided"
    cli.main(["guided", str(tmp_path / "r.fastq"), str(tmp_path / "r.paf"), str(out)])
    sites = [tuple(r) for r in spark.read.csv(str(out / "sites_final"), sep="\t").collect()]
    assert sites == [("0", "108", "30", "34", "34", "3", "P"), ("0", "108", "74", "78", "78", "0", "C")]
    assert spark.read.text(str(out / "stats")).first()[0] == "2 3 1 2 1 1 1 1"
    assert sorted(r["read_id"] for r in read_fastq(spark, str(out / "pairs" / "side=2")).collect()) == ["a:1-2/2"]


def test_windows_command_and_stages(spark, tmp_path, monkeypatch):
    seq = "A" * 30 + "CATG" + "T" * 40 + "CATG" + "G" * 30
    (tmp_path / "r.fastq").write_text(f"@a x\n{seq}\n+\n{'I' * len(seq)}\n@b\nTTT\n+\nIII\n")
    for name, value in (("WINDOW", "100"), ("WINDOW_OVERLAP", "40"), ("GZ_LEVEL", "1"), ("KEEP_CHUNKS", "1")):
        monkeypatch.setenv(name, value)
    out = tmp_path / "out"
    cli.main(["windows", str(tmp_path / "r.fastq"), str(out)])
    queries = {r["read_id"]: r["seq"] for r in read_fasta(spark, str(out / "windows")).collect()}
    assert queries == {"a_W0": seq[:100], "a_W8": seq[8:], "b_W0": "TTT"}
    kept = Manifest(spark, str(out / "stages" / "windows"))
    assert (kept.count("genome"), kept.count("windows"), Manifest(spark, str(out / "stages")).count("reads")) == (2, 3, 2)
    # an aligner's answer names windows; the run goes on from the reads that were staged
    (tmp_path / "r.paf").write_text("".join(f"a_W8\t100\t2\t52\t+\th{k}\t900\t10\t60\t50\t50\t60\tcg:Z:50M\n" for k in range(3)))
    stage = [f.stat().st_mtime_ns for f in (out / "stages" / "reads").glob("*.parquet")]
    cli.main(["guided", str(tmp_path / "r.fastq"), str(tmp_path / "r.paf"), str(out)])
    assert stage == [f.stat().st_mtime_ns for f in (out / "stages" / "reads").glob("*.parquet")]
    assert Manifest(spark, str(out / "stages")).count("blocks") == 3
    assert spark.read.text(str(out / "stats")).first()[0] == "2 3 1 2 1 1 1 1"
    one, two = chunk_lists(spark, str(out / "chunks"))
    assert one.endswith("chunk-00000_R1.fastq.gz") and [r["read_id"] for r in read_fastq(spark, two).collect()] == ["a:1-2/2"]
    # ids that are there twice or not at all are errors
    (tmp_path / "r.paf").write_text("zz\t100\t2\t52\t+\th\t900\t10\t60\t50\t50\t60\n")
    with pytest.raises(RuntimeError, match="alignments_of_unknown_reads"):
        cli.main(["guided", str(tmp_path / "r.fastq"), str(tmp_path / "r.paf"), str(tmp_path / "two")])
    (tmp_path / "r.fastq").write_text("@a\nACGT\n+\nIIII\n" * 2)
    (tmp_path / "r.paf").write_text("a\t4\t0\t4\t+\th\t900\t10\t14\t4\t4\t60\n")
    with pytest.raises(RuntimeError, match="repeated_read_ids"):
        cli.main(["guided", str(tmp_path / "r.fastq"), str(tmp_path / "r.paf"), str(tmp_path / "three")])


def test_chunks(spark, tmp_path):
    d = Digest(reads(spark, *["AACATGTTTTCATGGG" * 3] * 20).repartition(3), DigestConfig(min_mono_len=3))
    path = str(tmp_path / "c")
    for level in (9, 1):  # the second run takes the first one's place
        write_chunks(d.pairs, path, level)
    listed = read_chunk_list(spark, path).collect()
    assert sum(r["pairs"] for r in listed) == d.pairs.count() and len(listed) == 3
    assert sorted(f.name for f in (tmp_path / "c").iterdir()) == sorted([r[k] for r in listed for k in ("r1", "r2")] + ["chunks.json"])
    for r in listed:
        one, two = (gzip.open(tmp_path / "c" / r[k], "rt").read().split("\n")[0:-1:4] for k in ("r1", "r2"))
        assert len(one) == r["pairs"] and [x[:-1] for x in one] == [x[:-1] for x in two]
    broken = d.pairs.withColumn("r2_seq", F.when((F.col("read_idx") == 7) & (F.col("j") == 3), F.raise_error(F.lit("no sequence")).cast("string")).otherwise(F.col("r2_seq")))
    with pytest.raises(Exception, match="no sequence"):
        write_chunks(broken, str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").glob("**/*.gz")) and not (tmp_path / "bad" / "chunks.json").exists()
    write_chunks(d.pairs.limit(0), str(tmp_path / "none"))
    assert read_chunk_list(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="level"):
        write_chunks(d.pairs, path, 0)


def test_long_reads_take_time_in_proportion(spark):
    seq = ("CATG" + "ACGTTGCAAC" * 50) * 2000
    df = spark.createDataFrame([(1, "r", seq, "I" * len(seq), len(seq))], "read_idx bigint, read_id string, seq string, qual string, len bigint")
    d = Digest(df, DigestConfig(pair_mode="seq"))
    began = time.time()
    pairs = d.pairs.select("i", "j", F.length("r1_seq").alias("a"), F.col("r2_qual")).orderBy("i").collect()
    assert len(pairs) == 1999 and pairs[0][:3] == (1, 2, 504) and pairs[-1][:2] == (1999, 2000) and all(r["r2_qual"] == "I" * len(r["r2_qual"]) for r in pairs)
    assert d.monomers.count() == 2000 and time.time() - began < 30
    few = df.withColumns({c: F.substring(c, 1, 504 * 60) for c in ("seq", "qual")}).withColumn("len", F.length("seq").cast("bigint"))
    every = Digest(few, DigestConfig()).pairs.select("i", "j").collect()
    assert sorted(map(tuple, every)) == [(i, j) for i in range(1, 61) for j in range(i + 1, 61)]


def test_counters_come_with_the_pairs(spark, tmp_path):
    d = Digest(reads(spark, "AACATGTTTTCATGGG", "TTT"), DigestConfig(min_mono_len=3, dup_motif=True))
    pairs, seen = d.observed_pairs()
    spark.sparkContext.setJobGroup("observed", "one pass")
    sinks.write_pairs(pairs, str(tmp_path / "pairs"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("observed")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 1 and metrics(observed_metrics(spark, seen, DIGEST)) == metrics(d.stats)
    pairs, seen = Digest(reads(spark), DigestConfig()).observed_pairs()
    sinks.write_pairs(pairs, str(tmp_path / "none"))
    assert set(metrics(observed_metrics(spark, seen, DIGEST)).values()) == {0}


def test_buckets_join_without_moving_reads(spark):
    seqs = ["AACATG", "CATGAA", "AACATGTTTTCATGGG", "TTT"]
    config = GuidedConfig(dup_motif=False, min_mono_len=1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        g = bucketed_guided(reads(spark, *seqs), spark.createDataFrame([], ALIGN), config, n=3)
        assert spans(g.monomers) == spans(Guided(reads(spark, *seqs), spark.createDataFrame([], ALIGN), config).monomers)
        plan = g.pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_clock():
    assert [clock(x) for x in (0, 59.6, 3661, 360000)] == ["0:00:00", "0:01:00", "1:01:01", "100:00:00"]


def test_plans_do_not_shuffle_reads(spark):
    d = Digest(reads(spark, "AACATGTTTTCATGGG"), DigestConfig(min_mono_len=3))
    assert "Exchange" not in d.pairs._jdf.queryExecution().executedPlan().toString()
