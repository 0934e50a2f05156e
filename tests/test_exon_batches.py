"""Short exons between two introns: the look-up by halves against all pairs of introns."""

import random

import numpy as np
import pytest

from helixframe.operators.align import exon_batches, splits


def brute(edge, inner, out, near, firsts, seconds, text, sign, slack=12):
    def wrong(x, y):
        return sum(not (p == q or (q, p) in (("A", "G"), ("T", "C"))) for p, q in zip(x.upper(), y.upper()))

    best = None
    for a, b, m in firsts:
        i = a - edge + inner
        if abs(a - edge) > slack or i < 0 or len(near) < i:
            continue
        for c, d, m2 in seconds:
            exon, rest = c - b, len(out) - i - (c - b)
            if not m & m2 or not 1 <= exon <= 60 or rest < 4:
                continue
            want = text[b][:exon] + text[d][:rest]
            if len(want) != len(out) - i:
                continue
            n = wrong(out[i:], want)
            if n > (len(out) - i) // 10:
                continue
            order = (n + wrong(out[:i], near[:i]), abs(d - a), sign * a, sign * b, sign * c, sign * d)
            if best is None or order < best[0]:
                best = order, (a, b, c, d, i, exon, rest, n)
    return best and best[1]


@pytest.mark.parametrize("seed", range(12))
def test_halves_against_all_pairs(seed):
    r, sign = random.Random(seed), (1, -1)[seed % 2]
    letters = ("ACGT", "AG", "ACGTN", "acGT")[seed % 4]
    seq = "".join(r.choice(letters) for _ in range(420))
    longest = 60 if seed % 3 else 130
    base = 0 if sign == 1 else -420
    lib = {(base + x, base + x + r.randint(20, 90)): r.randint(1, 3) for x in (r.randint(40, 270) for _ in range(150))}
    lib = [(x, y, m) for (x, y), m in lib.items()]
    text = {y: seq[y - base : y - base + longest] for _, y, _ in lib}
    reads = []
    for _ in range(30):
        a, b, m = r.choice(lib)
        after = [(c, d) for c, d, m2 in lib if m & m2 and 1 <= c - b <= 60]
        if not after:
            continue
        c, d = r.choice(after)
        inner, over, n = r.randint(1, 12), r.randint(-3, 3), r.choice((4, 6, 12, 30, longest - 20))
        edge = a + over
        told = seq[edge - inner - base : a - base] + seq[b - base : c - base] + seq[d - base : d - base + n]
        told = "".join(r.choice("ACGT") if r.random() < 0.04 else "G" if x == "A" and r.random() < 0.2 else x for x in told)
        reads.append((edge, inner, told[: longest], seq[edge - inner - base : edge + 14 - base]))
    reads.sort()
    arrays = tuple(np.array(x) for x in zip(*lib))
    introns = exon_batches.Introns(arrays, arrays, np.array(list(text)), list(text.values()), sign, splits.LONGEST_EXON, splits.BEHIND, splits.REACH)
    got = introns.lay(*map(list, zip(*reads)))
    want = [brute(*x, lib, lib, text, sign) for x in reads]
    assert got == want and sum(x is not None for x in want) >= 3


def test_a_stretch_gets_introns_not_pairs(spark):
    """4,000 introns at one place make 4,000,000 pairs with those behind the exon; a stretch of reads gets each of them once."""
    lib = spark.createDataFrame([("c", 100, 300 + i, False) for i in range(20)] + [("c", 310 + i % 40, 1000 + i, False) for i in range(4000)], "chrom string, start long, end long, minus boolean")
    near = spark.createDataFrame([("c", 0), ("other", 7)], "chrom string, bin long")
    firsts, seconds = splits._exon_introns(near, splits._outward(lib, True), 12)
    assert firsts.count() == 20 and 3900 <= seconds.count() <= 4020
