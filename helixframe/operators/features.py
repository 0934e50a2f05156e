"""The 27 evidence features of candidate sites, and their scores.

sites: ord, chrom, pos (1-based). obs: observations merged by template. refs:
chrom, pos (0-based), base. All but the Bayes factors is in Spark's own
operations; sums over reads are of integers, or of values grouped by
distance first, so results don't depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import dna
from helixframe.functions.likelihood import bayes_factors_col
from helixframe.functions.trees import Model, score_col
from helixframe.operators import base_kernels, pileup, rangejoin
from helixframe.session import shared_path, written

RADIUS = 200

# The model's features, in its order.
NAMES = [
    "log_depth", "log_alt", "vaf", "noncanonical_fraction", "log_bf_uniform_vs_error", "log_bf_uniform_vs_homo",
    "alt_mean_bq", "ref_mean_bq", "alt_mean_mapq", "alt_mean_end_fraction", "strand_log_odds_abs",
    "alt_mean_softclip_fraction", "alt_mean_gap_nearness", "neighbor_target_read_rate", "neighbor_target_site_rate",
    "neighbor_other_read_rate", "neighbor_log_templates", "neighbor_template_reuse", "neighbor_log_opportunities",
    "neighbor_log_depth", "motif_prev_A", "motif_prev_C", "motif_prev_G", "motif_next_A", "motif_next_C", "motif_next_G", "alu",
]


def _nan() -> Column:
    return F.lit(float("nan"))


def _rate(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(_nan())


def _weighed(pair: Column) -> Column:
    """Mean of (v, n) pairs, summed in order of v; null without any."""
    r = F.array_sort(F.collect_list(pair))
    return F.try_divide(F.aggregate(r, F.lit(0.0), lambda a, x: a + x["v"] * x["n"]), F.aggregate(r, F.lit(0).cast("long"), lambda a, x: a + x["n"]))


def with_reference(sites: DataFrame, refs: DataFrame) -> DataFrame:
    """sites with ref, alt (null for an unsupported base), previous and following base in transcript direction."""
    r = refs.select("chrom", F.col("pos").alias("p"), "base")
    at = sites.withColumn("p0", F.col("pos") - 1)
    for name, move in (("base", 0), ("before", -1), ("after", 1)):
        own = r.select("chrom", (F.col("p") - move).alias("p0"), F.col("base").alias(name))
        at = at.join(own, ["chrom", "p0"], "left")
    ref = F.upper(F.col("base"))
    before, after = F.coalesce("before", F.lit("N")), F.coalesce("after", F.lit("N"))
    minus = ref == "T"
    return at.select(
        *sites.columns, "p0", ref.alias("ref"), dna.edit_alt(ref).alias("alt"),
        F.when(minus, dna.complement(after)).otherwise(before).alias("previous"),
        F.when(minus, dna.complement(before)).otherwise(after).alias("following"),
    )


#: Values of observations of the alternative base whose means are features.
OF_ALT = ("mapq", "end_fraction", "softclip_fraction", "gap_nearness")


def own_tallies(sites: DataFrame, obs: DataFrame) -> DataFrame:
    """Different values of the sites' observations, counted: ord, kind (0 reference, 1 alternative, 2 other), i, v, orientation, n.

    i 0 is the base quality, of each observation; 1 to 4 are OF_ALT, of the alternative base. One pass, counted before rows meet: a site of
    a million observations has some thousands of different values.
    """
    at = sites.select("ord", "chrom", "p0", "ref", "alt").join(obs.withColumnRenamed("pos", "p0"), ["chrom", "p0"])
    kind = F.when(F.col("base") == F.col("ref"), 0).when(F.col("base") == F.col("alt"), 1).otherwise(2)
    value = lambda i, c: F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"))
    values = F.when(kind == 1, F.array(value(0, "bq"), *[value(i, c) for i, c in enumerate(OF_ALT, 1)])).otherwise(F.array(value(0, "bq")))
    each = at.select("ord", kind.alias("kind"), "orientation", F.explode(values).alias("x")).filter("x.i = 0 or (x.v is not null and not isnan(x.v))")
    return each.groupBy("ord", "kind", "x.i", "x.v", F.when(F.col("x.i") == 0, F.col("orientation")).otherwise(0).alias("orientation")).agg(F.count("*").alias("n"))


def own_features(sites: DataFrame, obs: DataFrame, keep: str | None = None) -> DataFrame:
    """Features of the site's own observations. sites: with_reference(). keep: where the tallies are written; by default a new path in the shared folder."""
    return _of_own(written(own_tallies(sites, obs), keep or shared_path(obs.sparkSession, "tallies")))


def _of_own(t: DataFrame) -> DataFrame:
    """t: own_tallies()."""
    # sums over counts of equal values in order of value, so partitions don't matter
    by_quality = t.filter("i = 0").groupBy("ord", "kind", F.col("v").alias("bq")).agg(F.sum("n").alias("n"))
    pair = lambda k: F.when(F.col("kind") == k, F.struct(F.col("bq").alias("v"), "n"))
    bayes = by_quality.groupBy("ord").agg(
        F.array_sort(F.collect_list(F.struct("kind", F.col("bq").cast("int").alias("bq"), "n"))).alias("counts"), _weighed(pair(1)).alias("alt_mean_bq"), _weighed(pair(0)).alias("ref_mean_bq")
    )
    bayes = bayes.select("ord", bayes_factors_col(F.col("counts")).alias("bf"), *[F.coalesce(F.col(c), _nan()).alias(c) for c in ("alt_mean_bq", "ref_mean_bq")])
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("double")
    alt, ref, up, down = F.col("kind") == 1, F.col("kind") == 0, F.col("orientation") == 0, F.col("orientation") == 1
    a = t.filter("i = 0").groupBy("ord").agg(
        F.sum("n").cast("double").alias("depth"), n(alt).alias("n_alt"), n(ref).alias("n_ref"),
        n(alt & up).alias("a0"), n(alt & down).alias("a1"), n(ref & up).alias("r0"), n(ref & down).alias("r1"),
    )
    of = lambda i: F.when(F.col("i") == i, F.struct("v", "n"))
    means = t.filter("i > 0").groupBy("ord").agg(*[_weighed(of(i)).alias(f"alt_mean_{c}") for i, c in enumerate(OF_ALT, 1)])
    a = a.join(means, "ord", "left").withColumns({f"alt_mean_{c}": F.coalesce(F.col(f"alt_mean_{c}"), _nan()) for c in OF_ALT})
    half = lambda c: F.log(F.col(c) + 0.5)
    strand = F.when((F.col("n_alt") > 0) & (F.col("n_ref") > 0), F.abs(half("a0") - half("a1") - half("r0") + half("r1"))).otherwise(_nan())
    a = a.select(
        "ord", F.log1p("depth").alias("log_depth"), F.log1p("n_alt").alias("log_alt"),
        _rate(F.col("n_alt"), F.col("depth")).alias("vaf"), _rate(F.col("depth") - F.col("n_alt") - F.col("n_ref"), F.col("depth")).alias("noncanonical_fraction"),
        "alt_mean_mapq", "alt_mean_end_fraction", strand.alias("strand_log_odds_abs"), "alt_mean_softclip_fraction", "alt_mean_gap_nearness",
    )
    return a.join(bayes, "ord").select("*", F.col("bf.error").alias("log_bf_uniform_vs_error"), F.col("bf.homo").alias("log_bf_uniform_vs_homo")).drop("bf")


def neighbour_counts(obs: DataFrame, refs: DataFrame) -> DataFrame:
    """chrom, pos, base (upper case), n, and n_a to n_t for each observed position with a known reference base."""
    return _with_base(obs.groupBy("chrom", "pos").agg(F.count("*").alias("n"), *[F.count_if(F.col("base") == b).alias(f"n_{b}") for b in dna.BASES]), refs)


def _with_base(counts: DataFrame, refs: DataFrame) -> DataFrame:
    known = refs.select("chrom", "pos", F.upper("base").alias("base")).filter(F.col("base").isin(*dna.BASES))
    return counts.join(known, ["chrom", "pos"])


def neighbour_features(sites: DataFrame, obs: DataFrame, refs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """neighbour_rates(), and how far templates repeat."""
    reuse = template_reuse(sites.select("ord", "chrom", "p0", "ref", "alt"), edited_observations(obs, refs), radius)
    return neighbour_rates(sites, obs, refs, radius).join(reuse, "ord", "full")


def neighbour_rates(sites: DataFrame, obs: DataFrame, refs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rates in the positions around each site, weighed by exp(-distance / radius). obs: chrom, pos and base are enough."""
    return _rates(sites, neighbour_counts(obs, refs), radius)


def _rates(sites: DataFrame, counts: DataFrame, radius: int) -> DataFrame:
    """counts: neighbour_counts()."""
    own = sites.select("ord", "chrom", "p0", "ref", "alt")
    near = rangejoin.band(own, counts.withColumnRenamed("base", "lr"), "p0", "pos", radius).filter("pos <> p0")
    pick = lambda base: F.expr(f"CASE {base} WHEN 'A' THEN n_A WHEN 'C' THEN n_C WHEN 'G' THEN n_G WHEN 'T' THEN n_T END")
    same = F.col("lr") == F.col("ref")
    near = near.withColumn("n_alt", F.when(same, pick("alt")).otherwise(0)).withColumn("n_own", pick("lr")).withColumn("d", F.abs(F.col("pos") - F.col("p0")))
    # whole numbers by distance first, so the weighted sums have one order
    by = near.groupBy("ord", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") - F.col("n_own") - F.col("n_alt")).alias("other"),
        F.sum(F.when(same, 1).otherwise(0)).alias("places"), F.sum(F.when(same, F.col("n")).otherwise(0)).alias("same_n"),
        F.sum("n_alt").alias("alt_n"), F.sum(F.when(F.col("n_alt") > 0, 1).otherwise(0)).alias("alt_places"),
    )
    rows = by.groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("d", "n", "other", "places", "same_n", "alt_n", "alt_places"))).alias("r"))
    total = lambda f: F.aggregate("r", F.lit(0.0), lambda a, x: a + F.exp(-x["d"].cast("double") / radius) * x[f])
    w = rows.select("ord", total("n").alias("wn"), total("other").alias("wo"), total("places").alias("wp"), total("same_n").alias("ws"), total("alt_n").alias("wa"), total("alt_places").alias("wap"))
    return w.select("ord", _rate(F.col("wa"), F.col("ws")).alias("neighbor_target_read_rate"), _rate(F.col("wap"), F.col("wp")).alias("neighbor_target_site_rate"), _rate(F.col("wo"), F.col("wn")).alias("neighbor_other_read_rate"), F.log1p("wp").alias("neighbor_log_opportunities"), F.log1p("ws").alias("neighbor_log_depth"))


def edited_observations(obs: DataFrame, refs: DataFrame) -> DataFrame:
    """chrom, pos, template, lr (the reference base) of observations of the base that editing yields."""
    edited = obs.filter(F.col("base").isin("G", "C")).select("chrom", "pos", "template", "base")
    edited = edited.join(refs.select("chrom", "pos", F.upper("base").alias("lr")), ["chrom", "pos"])
    return edited.filter(F.col("base") == dna.edit_alt(F.col("lr"))).drop("base")


def template_reuse(sites: DataFrame, edited: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each site (ord, chrom, p0, ref) how templates repeat at the edited places of its own kind within the radius, without its own place.

    A sweep: as the middle moves along the contig, the number k of a template's places in reach changes only where one comes in or goes out. A template's few
    places give these steps of (k > 0, k, k(k - 1)); steps are summed by place, and their running sums are read off at the sites. So rows are linear in
    observations, whatever the depth or the radius. Returns ord, neighbor_log_templates, neighbor_template_reuse of sites with such a place.
    """
    e = F.col("e")
    within = lambda low, high: F.size(F.filter(e, lambda y: (y >= low) & (y <= high))).cast("long")
    step = lambda x, t, s, p: F.struct(x.alias("x"), t.cast("long").alias("t"), s.cast("long").alias("s"), p.cast("long").alias("p"))
    # of equal places, comings count before goings
    came = F.transform(e, lambda y: step(y - radius, F.when(within(y - 2 * radius - 1, y - 1) == 0, 1).otherwise(0), F.lit(1), 2 * within(y - 2 * radius - 1, y - 1)))
    gone = F.transform(e, lambda y: step(y + radius + 1, F.when(within(y, y + 2 * radius + 1) == 1, -1).otherwise(0), F.lit(-1), -2 * (within(y, y + 2 * radius + 1) - 1)))
    # what a place's own observation adds there
    own = F.transform(e, lambda y: step(y, F.when(within(y - radius, y + radius) == 1, 1).otherwise(0), F.lit(1), 2 * (within(y - radius, y + radius) - 1)))
    templates = edited.select("chrom", "template", "lr", F.col("pos").cast("long").alias("pos")).groupBy("chrom", "template", "lr").agg(F.collect_list("pos").alias("e"))  # a template's own bases
    sums = [F.sum(f"v.{c}").alias(c) for c in "tsp"]
    steps = templates.select("chrom", "lr", F.explode(F.concat(came, gone)).alias("v")).groupBy("chrom", "lr", F.col("v.x").alias("x")).agg(*sums)
    selves = templates.select("chrom", "lr", F.explode(own).alias("v")).groupBy("chrom", "lr", F.col("v.x").alias("x")).agg(*[c.alias(f"own_{n}") for n, c in zip("tsp", sums)])
    return _swept(sites, steps, selves)


def _swept(sites: DataFrame, steps: DataFrame, selves: DataFrame) -> DataFrame:
    """Running sums of steps (chrom, lr, x, t, s, p) at the sites, without their own shares (own_t, own_s, own_p)."""
    asked = sites.select("chrom", F.col("ref").alias("lr"), F.col("p0").cast("long").alias("x"), "ord")
    both = steps.withColumn("ord", F.lit(None).cast(dict(asked.dtypes)["ord"])).unionByName(asked, allowMissingColumns=True)
    both = rangejoin.carried(both, ["chrom", "lr"], "x", {f"b_{c}": F.sum(c) for c in "tsp"}, {f"b_{c}": F.sum(f"b_{c}") for c in "tsp"})
    order = Window.partitionBy("chrom", "lr", "__bin").orderBy("x", F.col("ord").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    whole = both.select("chrom", "lr", "x", "ord", *[(F.coalesce(f"b_{c}", F.lit(0)) + F.coalesce(F.sum(c).over(order), F.lit(0))).alias(c) for c in "tsp"]).filter("ord is not null")
    at = whole.join(selves, ["chrom", "lr", "x"], "left").select("ord", *[(F.col(c) - F.coalesce(f"own_{c}", F.lit(0))).alias(c) for c in "tsp"]).filter("t > 0")
    return at.select("ord", F.log1p(F.col("t").cast("double")).alias("neighbor_log_templates"), F.when(F.col("s") > 1, F.col("p") / (F.col("s") * (F.col("s") - 1))).otherwise(0.0).alias("neighbor_template_reuse"))


def around(rows: DataFrame, sites: DataFrame, radius: int) -> DataFrame:
    """The rows (chrom, pos) in bins within reach of a site: nothing else can be evidence. A semi-join on distinct bins."""
    width = 4 * radius
    p0 = F.col("pos") - 1
    near = sites.select("chrom", F.explode(F.sequence(F.floor((p0 - radius - 1) / width), F.floor((p0 + radius + 1) / width))).alias("__b")).distinct()
    return rows.withColumn("__b", F.floor(F.col("pos") / width)).join(near, ["chrom", "__b"], "left_semi").drop("__b")


def features(sites: DataFrame, obs: DataFrame, refs: DataFrame, alu: DataFrame | None = None, radius: int = RADIUS, keep: str | None = None) -> DataFrame:
    """ord, chrom, pos, error (null, or why a site has no features), and the features as doubles.

    keep: a folder for the sites and the tallies of observations; by default a new one in the shared folder. Of observations, a row a base, three groups of features
    are made, each of the columns that it needs: record_features() needs no such rows.
    """
    keep = keep or shared_path(obs.sparkSession, "tallies")
    sites, at, refs = _known(sites, refs, radius, keep)
    good = at.filter("alt is not null")
    obs = around(obs, sites, radius)
    return _together(at, own_features(good, obs, f"{keep}/own"), neighbour_features(good, obs, refs, radius), alu)


def record_features(sites: DataFrame, alignments: DataFrame, refs: DataFrame, alu: DataFrame | None = None, radius: int = RADIUS, keep: str | None = None) -> DataFrame:
    """features() of the merged observations of alignments, which are made once and counted in the tasks that make them."""
    keep = keep or shared_path(alignments.sparkSession, "tallies")
    _, at, refs = _known(sites, refs, radius, keep)
    good = at.filter("alt is not null")
    return _of_tallies(at, _tallied(good, alignments, refs, radius, keep, None), refs, alu, radius, keep)


def discovered_features(alignments: DataFrame, refs: DataFrame, number: Column, alu: DataFrame | None = None, radius: int = RADIUS, keep: str | None = None, places: DataFrame | None = None) -> DataFrame:
    """record_features() of the sites that pileup.discover() finds in alignments, whose bases are counted in the same pass. number: of chrom and pos, the sites' ord.

    places: records (chrom, pos, cigar) among which are those of all alignments; by default the alignments, which are then read twice.
    """
    keep = keep or shared_path(alignments.sparkSession, "tallies")
    refs = written(refs, f"{keep}/refs")
    t = _tallied(refs.filter(F.col("base").isin("A", "T")).select("chrom", F.col("pos").alias("p0")), alignments, refs, radius, keep, places)
    counts = _bases(t, 1).select("chrom", "pos", F.col("n").alias("depth"), *[F.col(f"n_{b}").alias(b.lower()) for b in dna.BASES])
    sites = written(pileup.candidates(counts, refs).select(number.alias("ord"), "chrom", "pos"), f"{keep}/found")
    return _of_tallies(written(with_reference(sites, refs), f"{keep}/sites"), t, refs, alu, radius, keep)


def _tallied(sites: DataFrame, alignments: DataFrame, refs: DataFrame, radius: int, keep: str, places: DataFrame | None) -> DataFrame:
    """pileup.tallies() as a table. sites: chrom, p0."""
    shapes = (pileup.usable(alignments) if places is None else places).filter("cigar is not null and pos >= 0").select("chrom", F.col("pos").cast("long").alias("pos"), "cigar").distinct()
    marks = _marks(written(shapes, f"{keep}/shapes"), refs, sites)  # told apart before paths are made
    return written(pileup.tallies(alignments, written(marks, f"{keep}/marks"), radius), f"{keep}/counted")


def _bases(t: DataFrame, before: int) -> DataFrame:
    """chrom, pos, n and n_A to n_T; before templates are merged or after."""
    base = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    each = t.filter((F.col("what") == base_kernels.BASE) & (F.col("orientation") == before))
    return each.groupBy("chrom", "pos").agg(F.sum("n").alias("n"), *[base(k).alias(f"n_{b}") for k, b in enumerate(dna.BASES)])


def _of_tallies(at: DataFrame, t: DataFrame, refs: DataFrame, alu: DataFrame | None, radius: int, keep: str) -> DataFrame:
    good = at.filter("alt is not null")
    own = good.select("ord", "chrom", F.col("p0").alias("pos")).join(t.filter(F.col("what") < base_kernels.BASE), ["chrom", "pos"])
    own = written(own.select("ord", "kind", F.col("what").alias("i"), "v", "orientation", "n"), f"{keep}/own")
    swept = lambda what, name: t.filter(F.col("what") == what).select("chrom", F.when(F.col("kind") == 0, "A").otherwise("T").alias("lr"), F.col("pos").alias("x"), *[F.col(c).alias(name + n) for n, c in zip("tsp", "nsp")])
    reuse = _swept(good, swept(base_kernels.STEP, ""), swept(base_kernels.SELF, "own_"))
    return _together(at, _of_own(own), _rates(good, _with_base(_bases(t, 0), refs), radius).join(reuse, "ord", "full"), alu)


def _marks(shapes: DataFrame, refs: DataFrame, sites: DataFrame) -> DataFrame:
    """shapes (chrom, pos, cigar) with path and marks, the texts of the path's pieces, for base_kernels.tally(). Those without a known base are left out."""
    grain = base_kernels.GRAIN
    here = sites.select("chrom", F.col("p0").alias("pos")).distinct().withColumn("site", F.lit(True))
    base = F.upper("base")
    letter = F.when(~base.isin(*dna.BASES), "N").when(F.col("site"), F.lower(base)).otherwise(base)
    each = refs.join(here, ["chrom", "pos"], "left").select("chrom", F.floor(F.col("pos") / grain).alias("piece"), F.struct(F.pmod("pos", F.lit(grain)).cast("int").alias("at"), F.coalesce(letter, F.lit("N")).alias("b")).alias("x"))
    pieces = each.groupBy("chrom", "piece").agg(F.array_sort(F.collect_list("x")).alias("a"))
    unknown = lambda x, i: F.repeat(F.lit("N"), x["at"] - F.coalesce(F.get("a", i - 1)["at"], F.lit(-1)) - 1)
    pieces = pieces.select("chrom", "piece", F.rpad(F.array_join(F.transform("a", lambda x, i: F.concat(unknown(x, i), x["b"])), ""), grain, "N").alias("text"))
    shapes = shapes.withColumn("path", pileup.path())
    parts = shapes.select("chrom", "path").distinct().select("chrom", "path", F.posexplode("path").alias("i", "piece")).join(pieces, ["chrom", "piece"], "left")
    whole = parts.groupBy("chrom", "path").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("text", F.lit("N" * grain)).alias("text")))).alias("t"), F.count("text").alias("n"))
    return shapes.join(whole.filter("n > 0").select("chrom", "path", F.array_join(F.transform("t", lambda x: x["text"]), "").alias("marks")), ["chrom", "path"]).select("chrom", "pos", "cigar", "path", "marks")


def _known(sites: DataFrame, refs: DataFrame, radius: int, keep: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """sites, the same with_reference(), and refs around them, as tables."""
    # read by every part; and Spark knows the sizes of tables, so it is these that it broadcasts, if any, not observations
    sites = written(sites, f"{keep}/found")
    refs = written(around(refs, sites, radius), f"{keep}/refs")
    return sites, written(with_reference(sites, refs), f"{keep}/sites"), refs


def _together(at: DataFrame, own: DataFrame, near: DataFrame, alu: DataFrame | None) -> DataFrame:
    good = at.filter("alt is not null")
    if alu is None:
        flagged = good.withColumn("alu", F.lit(False))
    else:
        flagged = rangejoin.contained(good, alu, "p0", "alu")
    motif = lambda c, b: F.when(F.col(c) == b, 1.0).when(F.col(c).isin(*dna.BASES), 0.0).otherwise(_nan())
    out = flagged.join(own, "ord", "left").join(near, "ord", "left")
    zero = ["log_depth", "log_alt", "log_bf_uniform_vs_error", "log_bf_uniform_vs_homo", "neighbor_log_templates", "neighbor_template_reuse", "neighbor_log_opportunities", "neighbor_log_depth"]
    for side, column in (("prev", "previous"), ("next", "following")):
        for b in "ACG":
            out = out.withColumn(f"motif_{side}_{b}", motif(column, b))
    out = out.withColumn("alu", F.col("alu").cast("double"))
    values = [F.coalesce(F.col(c), F.lit(0.0) if c in zero else _nan()).alias(c) for c in NAMES]
    good_rows = out.select("ord", "chrom", "pos", F.lit(None).cast("string").alias("error"), *values)
    bad = at.filter("alt is null").select("ord", "chrom", "pos", F.format_string("unsupported reference base at %s:%d", "chrom", "pos").alias("error"), *[_nan().alias(c) for c in NAMES])
    return good_rows.unionByName(bad)


def score(found: DataFrame, model: Model, strict: bool = True) -> DataFrame:
    """ord, chrom, pos, score. strict: one site without features fails the call, as scoring is all or nothing."""
    if strict:
        wrong = found.filter("error is not null").select("error").limit(1).collect()
        if wrong:
            raise ValueError(wrong[0][0])
    row = F.array(*[F.col(c).cast("float") for c in NAMES])
    return found.filter("error is null").select("ord", "chrom", "pos", score_col(row, model).alias("score"))
