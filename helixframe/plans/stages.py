"""The run: four legal entries, stages over Parquet outputs, and resumption at the first stage that isn't whole.

A stage writes its table under a temporary name and moves it, then writes a seal
with its row count; a stage is whole if seal and table agree. Changing an option, or what stands in an input, changes
the run's fingerprint, and resuming with another one is refused. Inputs of the size and time that the manifest holds aren't read again for that.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import features, kmer_index, pairs, pileup, qc, report, vcf
from helixframe.operators.align import mapper
from helixframe.sources import bam, fastq, files, text

STAGES = ("qc", "map", "sort", "scan", "score", "vcf", "report")
#: A stage of several sealed tables: mapping, then the records with rescued ones in their stead.
PARTS = {"map": ("map", "rescue")}
VERSION = 3


@dataclass
class RunParams:
    """Inputs and options. Entries: reads; alignments; alignments with a site list; a site table to report on."""

    out: str
    fasta: str
    r1: list[str] = field(default_factory=list)
    r2: list[str] = field(default_factory=list)
    bam: str | None = None
    sites: str | None = None
    vcf: str | None = None
    gtf: str | None = None
    alu: str | None = None
    model: str | None = None
    threshold: float = 0.5
    n_trees: int | None = 400
    tile: int = 1 << 16
    kmer: int = 15
    window: int = 10
    stop_after: str | None = None

    def entry(self) -> str:
        given = (bool(self.r1), self.bam is not None, self.sites is not None, self.vcf is not None)
        legal = {(True, False, False, False): "reads", (False, True, False, False): "bam", (False, True, True, False): "bam_sites", (False, False, False, True): "vcf"}
        if given not in legal or self.r2 and not self.r1:
            raise ValueError("give reads, or a BAM file, or a BAM file with sites, or a VCF file")
        if self.stop_after and self.stop_after not in STAGES:
            raise ValueError(f"no stage {self.stop_after}")
        return legal[given]

    def inputs(self) -> list[str]:
        return [x for x in (self.fasta, *self.r1, *self.r2, self.bam, self.sites, self.vcf, self.gtf, self.alu, self.model) if x]

    def fingerprint(self) -> str:
        """Of the options and the inputs' paths."""
        own = {k: v for k, v in asdict(self).items() if k not in ("out", "stop_after")}
        return hashlib.sha256(json.dumps([VERSION, own], sort_keys=True).encode()).hexdigest()


class RunLock:
    """An exclusive file in the run's folder (local folders; elsewhere the scheduler keeps runs apart)."""

    def __init__(self, out: str):
        self.path = None if "://" in out and not out.startswith("file://") else f"{out.removeprefix('file://')}/run.lock"

    def __enter__(self) -> RunLock:
        if self.path:
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            try:
                os.close(os.open(self.path, os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                raise RuntimeError(f"another run holds {self.path}") from None
        return self

    def __exit__(self, *_) -> None:
        if self.path:
            os.unlink(self.path)


class Run:
    def __init__(self, spark: SparkSession, params: RunParams):
        self.spark, self.p, self.entry = spark, params, params.entry()
        self._refs: tuple[DataFrame, DataFrame] | None = None
        self._inputs: dict[str, dict] | None = None

    # ---- what the run is of ----

    @property
    def manifest(self) -> str:
        return f"{self.p.out.rstrip('/')}/run.json"

    def inputs(self) -> dict[str, dict]:
        """Size, time and digest of each input file."""
        if self._inputs is None:
            before = json.loads(files.read_text(self.manifest)).get("inputs", {}) if files.exists(self.manifest) else {}
            stamps = {x: files.stamp(x) for x in dict.fromkeys(self.p.inputs())}
            known = {x: before[x] for x, s in stamps.items() if s and s["modified"] and x in before and s.items() <= before[x].items()}
            new = files.digests(self.spark, [x for x, s in stamps.items() if s and x not in known])
            self._inputs = {x: known.get(x) or {**s, "digest": new[x]} for x, s in stamps.items() if s}
        return self._inputs

    def fingerprint(self) -> str:
        """Of the options and of what stands in the inputs."""
        return hashlib.sha256(json.dumps([self.p.fingerprint(), {x: s["digest"] for x, s in self.inputs().items()}], sort_keys=True).encode()).hexdigest()

    # ---- stages' outputs ----

    def path(self, stage: str) -> str:
        return f"{self.p.out.rstrip('/')}/{stage}.parquet"

    def seal(self, stage: str) -> str:
        return f"{self.p.out.rstrip('/')}/{stage}.seal.json"

    def table(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def whole(self, stage: str) -> bool:
        return all(self.sealed(p) for p in PARTS.get(stage, (stage,)))

    def sealed(self, stage: str) -> bool:
        """The seal is there, is of this run, and counts what the table holds."""
        if not files.exists(self.seal(stage)) or not files.exists(self.path(stage)):
            return False
        try:
            said = json.loads(files.read_text(self.seal(stage)))
            return said["fingerprint"] == self.fingerprint() and said["rows"] == self.table(stage).count()
        except Exception:  # a torn seal or table is no whole stage
            return False

    def write(self, stage: str, df: DataFrame, **notes) -> None:
        tmp = f"{self.path(stage)}.tmp"
        df.write.mode("overwrite").parquet(tmp)
        files.remove(self.seal(stage))
        files.remove(self.path(stage))
        files.move(tmp, self.path(stage))
        rows = self.table(stage).count()
        files.write_bytes(self.seal(stage), json.dumps({"fingerprint": self.fingerprint(), "rows": rows, **notes}).encode())

    def clean(self, stage: str) -> None:
        """Removes all after a stage, and of the stage what follows its first torn part."""
        parts = PARTS.get(stage, (stage,))
        torn = next((i for i, p in enumerate(parts) if not self.sealed(p)), 0)
        later = [p for s in STAGES[STAGES.index(stage) + 1 :] for p in PARTS.get(s, (s,))]
        for s in [*parts[torn:], *later]:
            files.remove(self.seal(s))
            files.remove(self.path(s))

    def notes(self, stage: str) -> dict:
        return json.loads(files.read_text(self.seal(stage))) if files.exists(self.seal(stage)) else {}

    # ---- inputs ----

    def reference(self) -> tuple[DataFrame, DataFrame]:
        if self._refs is None:
            self._refs = fastq.read_fasta(self.spark, self.p.fasta, self.p.tile, keep_case=True)
        return self._refs

    def stages(self) -> list[str]:
        first = STAGES.index({"reads": "qc", "bam": "scan", "bam_sites": "score", "vcf": "report"}[self.entry])
        out = [s for s in STAGES[first:] if not (s in ("score",) and self.p.model is None) and not (s == "report" and self.p.gtf is None)]
        return out[: out.index(self.p.stop_after) + 1] if self.p.stop_after in out else out

    def alignments(self) -> DataFrame:
        return self.table("sort") if self.entry == "reads" else bam.read_bam(self.spark, self.p.bam)

    # ---- the stages ----

    def qc(self) -> None:
        reads = fastq.read_fastq(self.spark, self.p.r1, self.p.r2 or None)
        judged, told = qc.run(reads, paired=bool(self.p.r2))
        self.write("qc", judged.filter("kept").select("lane", "ord", "mate", "name", "seq", "qual"), report=told)

    def map(self) -> None:
        """Two sealed parts: a run that stopped in rescue goes on there."""
        if not self.sealed("map"):
            self.placed()
        self.rescue()

    def placed(self) -> None:
        from helixframe.operators import transcripts

        contigs, tiles = self.reference()
        reads = self.table("qc").withColumn("ord", (F.col("lane").cast("long") * (1 << 40)) + F.col("ord") * 2 + F.col("mate") - 1)
        if self.p.gtf:
            library = transcripts.junction_library(text.transcripts(text.read_gtf(self.spark, self.p.gtf)))
        else:
            library = self.spark.createDataFrame([], "chrom string, start long, end long, minus boolean, support long")
        index_path, keep = f"{self.p.out.rstrip('/')}/map.index.parquet", f"{self.p.out.rstrip('/')}/map.parts"
        kmer_index.minimizer_index(tiles, self.p.tile, self.p.kmer, self.p.window).write.mode("overwrite").parquet(index_path)
        index = self.spark.read.parquet(index_path)
        records, _ = mapper.two_pass(reads, tiles, self.p.tile, library, keep=keep, kmer=self.p.kmer, w=self.p.window, index=index)
        if self.p.r2:
            records = records.withColumns({"template": F.floor(F.col("ord") / 2), "slot": F.pmod("ord", F.lit(2)).cast("int") + 1})
            records = mapper.pair_records(mapper.with_mates(records, tiles, self.p.tile, f"{keep}/mates"))
        self.write("map", records)
        files.remove(index_path)
        files.remove(keep)

    def rescue(self) -> None:
        _, tiles = self.reference()
        keep = f"{self.p.out.rstrip('/')}/rescue.parts"
        records = mapper.rescue_records(self.table("map"), tiles, self.p.tile, paired=bool(self.p.r2), keep=keep, kmer=self.p.kmer, w=self.p.window)
        self.write("rescue", records)
        files.remove(keep)

    def sort(self) -> None:
        contigs, _ = self.reference()
        self.write("sort", pairs.coordinate_order(self.table("rescue"), contigs))

    def scan(self) -> None:
        _, tiles = self.reference()
        counts = pileup.counted_bases(self.alignments())
        sites = pileup.candidates(counts, pileup.bases_at(counts, tiles, self.p.tile))
        self.write("scan", sites.withColumn("ord", F.xxhash64("chrom", "pos")))

    def listed_sites(self) -> DataFrame:
        if self.entry == "bam_sites":
            return text.read_sites(self.spark, self.p.sites)
        return self.table("scan")

    def score(self) -> None:
        from helixframe.functions import trees

        _, tiles = self.reference()
        model = trees.load_model(self.spark, self.p.model, n_trees=self.p.n_trees)
        alu = text.read_bed(self.spark, self.p.alu) if self.p.alu else None
        sites = self.listed_sites().select("ord", "chrom", "pos")
        around = sites.select("chrom", F.explode(F.sequence(F.greatest(F.col("pos") - 1 - features.RADIUS, F.lit(0)), F.col("pos") + features.RADIUS)).alias("pos")).distinct()
        keep = f"{self.p.out.rstrip('/')}/score.observations"
        found = features.record_features(sites, self.alignments(), pileup.bases_at(around, tiles, self.p.tile), alu, keep=keep)
        self.write("score", features.score(found, model))
        files.remove(keep)

    def vcf(self) -> None:
        sites = self.listed_sites()
        if self.p.model is not None:
            sites = sites.join(self.table("score").select("ord", "score"), "ord")
        else:
            sites = sites.withColumn("score", F.lit(0.0))
        if "ref" not in sites.columns:  # a list of places: the base is the reference's
            _, tiles = self.reference()
            refs = pileup.bases_at(sites.select("chrom", (F.col("pos") - 1).alias("pos")), tiles, self.p.tile)
            sites = sites.join(refs.select("chrom", (F.col("pos") + 1).alias("pos"), F.upper("base").alias("ref")).distinct(), ["chrom", "pos"])
        rows = vcf.records(sites, self.p.threshold)
        self.write("vcf", rows.orderBy("chrom", "pos"))

    def report(self) -> None:
        if self.entry == "vcf":
            rows = vcf.parse(self.spark.read.text(self.p.vcf)).withColumn("ord", F.monotonically_increasing_id())
        else:
            rows = self.table("vcf").select("ord", "chrom", "pos", (F.col("filter") == "PASS").alias("passed"), "score", *[F.col(c) for c in ("freq", "depth") if c in self.table("vcf").columns])
            rows = rows.withColumnRenamed("freq", "vaf") if "freq" in rows.columns else rows.withColumn("vaf", F.lit(0.0)).withColumn("depth", F.lit(0).cast("long"))
        gtf = text.read_gtf(self.spark, self.p.gtf).persist()
        _, tiles = self.reference()
        sites = report.with_genes(rows, text.genes(gtf))
        coding = report.cds_sequences(text.cds(gtf), tiles, self.p.tile)
        recoded = report.recodings(sites.filter(F.col("score") >= report.RECODE_SCORE), coding)
        self.write("report", report.gene_table(sites, recoded))

    def run(self, log: Callable[[str], None] = lambda _: None) -> list[str]:
        """Runs what isn't whole, and all after the first such stage. Returns the stages that ran."""
        if files.exists(self.manifest):
            before = json.loads(files.read_text(self.manifest))
            if before["fingerprint"] != self.fingerprint():
                raise ValueError("the folder holds a run of other inputs or options")
        with RunLock(self.p.out):
            told = {"version": VERSION, "fingerprint": self.fingerprint(), "entry": self.entry, "params": asdict(self.p), "inputs": self.inputs()}
            files.write_bytes(f"{self.manifest}.tmp", json.dumps(told).encode())
            files.move(f"{self.manifest}.tmp", self.manifest)
            todo = self.stages()
            first = next((i for i, s in enumerate(todo) if not self.whole(s)), len(todo))
            if first < len(todo):
                self.clean(todo[first])
            for s in todo[first:]:
                began = time.time()
                getattr(self, s)()
                log(f"{s}: {time.time() - began:.1f} s")
            return todo[first:]


def resume(spark: SparkSession, out: str) -> list[str]:
    """Goes on with the run whose manifest is in the folder."""
    said = json.loads(files.read_text(f"{out.rstrip('/')}/run.json"))
    if said["version"] != VERSION:
        raise ValueError(f"the run is of version {said['version']}")
    return Run(spark, RunParams(**said["params"])).run()


__all__ = ["STAGES", "Run", "RunLock", "RunParams", "resume"]
