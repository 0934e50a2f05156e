"""Alignment operations as array<struct<op string, n int>>: M, I, D, N, S.

All column functions are higher-order expressions; parsing and printing use
regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPE = "array<struct<op:string,n:int>>"


def parse(text: Column) -> Column:
    """``10M2I`` as operations; null or ``*`` as an empty array."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("*")), F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1))
    return F.transform(parts, lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, "^([0-9]+)", 1).cast("int").alias("n")))


def text(cigar: Column) -> Column:
    return F.when(F.size(cigar) == 0, "*").otherwise(F.array_join(F.transform(cigar, lambda x: F.concat(x["n"].cast("string"), x["op"])), ""))


def total(cigar: Column, ops: str) -> Column:
    """Sum of the lengths of the operations in ops."""
    return F.aggregate(cigar, F.lit(0), lambda a, x: a + F.when(x["op"].isin(*ops), x["n"]).otherwise(0))


def ref_length(cigar: Column) -> Column:
    return total(cigar, "MDN=X")


def read_length(cigar: Column) -> Column:
    return total(cigar, "MIS=X")


def ref_end(pos: Column, cigar: Column) -> Column:
    return pos + ref_length(cigar)


def count(cigar: Column, op: str) -> Column:
    return F.size(F.filter(cigar, lambda x: x["op"] == op))


def push(cigar: Column, op: Column, n: Column) -> Column:
    """Appends an operation, joined to the last one if it is of the same kind; nothing for length 0."""
    last = F.try_element_at(cigar, F.lit(-1))
    own = F.array(F.struct(op.alias("op"), n.cast("int").alias("n")))
    joined = F.concat(F.slice(cigar, 1, F.size(cigar) - 1), F.array(F.struct(op.alias("op"), (last["n"] + n).cast("int").alias("n"))))
    return F.when(n == 0, cigar).when(last["op"] == op, joined).otherwise(F.concat(cigar, own))


def compact(cigar: Column) -> Column:
    """Neighbouring operations of one kind joined, empty ones dropped."""
    return F.aggregate(cigar, F.array().cast(TYPE), lambda a, x: push(a, x["op"], x["n"]))


def blocks(pos: Column, cigar: Column) -> Column:
    """Aligned blocks: array<struct<ref long, read int, n int>>, one for each M."""
    start = F.struct(pos.cast("long").alias("r"), F.lit(0).alias("q"), F.array().cast("array<struct<ref:bigint,read:int,n:int>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        aligned = x["op"].isin("M", "=", "X")
        ref = a["r"] + F.when(x["op"].isin("M", "=", "X", "D", "N"), x["n"]).otherwise(0)
        read = a["q"] + F.when(x["op"].isin("M", "=", "X", "I", "S"), x["n"]).otherwise(0)
        own = F.array(F.struct(a["r"].alias("ref"), a["q"].alias("read"), x["n"].alias("n")))
        return F.struct(ref.alias("r"), read.alias("q"), F.when(aligned, F.concat(a["out"], own)).otherwise(a["out"]).alias("out"))

    return F.aggregate(cigar, start, step, lambda a: a["out"])


def gaps(cigar: Column) -> Column:
    """Places between read bases where the alignment has an insertion's ends, a deletion or an intron: array<double>."""
    start = F.struct(F.lit(0).alias("q"), F.array().cast("array<double>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        at, after = a["q"] - F.lit(0.5), a["q"] + x["n"] - F.lit(0.5)
        found = F.when(x["op"] == "I", F.array(at, after)).when(x["op"].isin("D", "N"), F.array(at)).otherwise(F.array().cast("array<double>"))
        read = a["q"] + F.when(x["op"].isin("M", "=", "X", "I", "S"), x["n"]).otherwise(0)
        return F.struct(read.alias("q"), F.concat(a["out"], found).alias("out"))

    return F.aggregate(cigar, start, step, lambda a: a["out"])


def introns(pos: Column, cigar: Column, kind: str = "N") -> Column:
    """N operations (or those of another kind) as array<struct<start long, end long>>."""
    start = F.struct(pos.cast("long").alias("r"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        end = a["r"] + F.when(x["op"].isin("M", "=", "X", "D", "N"), x["n"]).otherwise(0)
        own = F.array(F.struct(a["r"].alias("start"), end.alias("end")))
        return F.struct(end.alias("r"), F.when(x["op"] == kind, F.concat(a["out"], own)).otherwise(a["out"]).alias("out"))

    return F.aggregate(cigar, start, step, lambda a: a["out"])


def before_read(cigar: Column, depth: Column) -> Column:
    """The operations up to so many read bases; operations that use no read base stay if they stand before that place."""
    start = F.struct(F.lit(0).alias("q"), F.array().cast(TYPE).alias("out"))

    def step(a: Column, x: Column) -> Column:
        uses = x["op"].isin("M", "=", "X", "I", "S")
        take = F.when(uses, F.least(x["n"], F.greatest(depth - a["q"], F.lit(0)))).otherwise(F.when(a["q"] < depth, x["n"]).otherwise(0))
        return F.struct((a["q"] + F.when(uses, x["n"]).otherwise(0)).alias("q"), push(a["out"], x["op"], take).alias("out"))

    return F.aggregate(cigar, start, step, lambda a: a["out"])


def from_read(cigar: Column, depth: Column) -> Column:
    """The operations after so many read bases."""
    start = F.struct(F.lit(0).alias("q"), F.array().cast(TYPE).alias("out"))

    def step(a: Column, x: Column) -> Column:
        uses = x["op"].isin("M", "=", "X", "I", "S")
        after = a["q"] + F.when(uses, x["n"]).otherwise(0)
        take = F.when(uses, F.least(x["n"], F.greatest(after - depth, F.lit(0)))).otherwise(F.when(a["q"] >= depth, x["n"]).otherwise(0))
        return F.struct(after.alias("q"), push(a["out"], x["op"], take).alias("out"))

    return F.aggregate(cigar, start, step, lambda a: a["out"])


def annotated_micro_deletions(pos: Column, cigar: Column, known: Column, longest: int = 50) -> Column:
    """Deletions of up to ``longest`` bases that are known introns (array<struct<start,end>>) become N."""
    start = F.struct(pos.cast("long").alias("r"), F.array().cast(TYPE).alias("out"))

    def step(a: Column, x: Column) -> Column:
        end = a["r"] + F.when(x["op"].isin("M", "=", "X", "D", "N"), x["n"]).otherwise(0)
        hit = (x["op"] == "D") & (x["n"] <= longest) & F.exists(known, lambda j: (j["start"] == a["r"]) & (j["end"] == end))
        return F.struct(end.alias("r"), push(a["out"], F.when(hit, "N").otherwise(x["op"]), x["n"]).alias("out"))

    return F.aggregate(cigar, start, step, lambda a: a["out"])


def reg2bin(begin: Column, end: Column) -> Column:
    """The smallest bin of the binning index that holds [begin, end)."""
    last = F.greatest(end - 1, begin)
    out = F.lit(0)
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out = F.when(F.shiftright(begin, shift) == F.shiftright(last, shift), F.lit(first) + F.shiftright(begin, shift)).otherwise(out)
    return out.cast("int")
