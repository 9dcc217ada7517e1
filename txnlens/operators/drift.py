"""Drift between a reference and an analysis sample."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from txnlens.functions.stats import half_kl, ks_p_value, psi_term
from txnlens.operators.distribution import (MANY_VALUES, counts_at, number, numeric_counts, quantiles, running_counts,
                                            scan_counts_at, split_by_distinct, totals, wide_quantiles)
from txnlens.operators.encoding import apply_standard, category_counts, fit_standard, shares_of
from txnlens.operators.gappy_pca import Moments, components, fit_covariance, pattern_moments, project_expected
from txnlens.operators.lookup import join_lookup
from txnlens.operators.rowindex import with_row_index
from txnlens.operators.wide_tests import wide_two_sample
from txnlens.roles import DRIFT_CATEGORICAL, DRIFT_NUMERICAL, EVENT_TIME, KEY
from txnlens.session import materialize

PSI_LIMIT = 0.1
JS_LIMIT = 0.25
TEST_LIMIT = 0.05
DRIFT_SHARE = 0.5
SAMPLES = ("ref", "ana")


def sample_counts(ref: DataFrame, ana: DataFrame, columns=DRIFT_NUMERICAL) -> DataFrame:
    """Stored counts of the distinct values of both samples; what every numeric drift score starts from."""
    return numeric_counts({"ref": ref, "ana": ana}, columns)


# Population stability index

def quantile_edges(counts: DataFrame, bins) -> DataFrame:
    """(feature, bins, i, edge) for i = 0..bins: interpolated percentiles of the reference."""
    grid = [(i, b) for b in bins for i in range(b + 1)]
    return _named_edges(quantiles(counts, "ref", grid))


def _named_edges(found: DataFrame) -> DataFrame:
    return found.select("feature", F.col("den").alias("bins"), F.col("num").alias("i"), F.col("value").alias("edge"))


def width_edges(counts: DataFrame, bins) -> DataFrame:
    """(feature, bins, i, edge): equal-width edges over the range of the reference."""
    span = counts.where("ref > 0").groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return _span_edges(span, bins)


def _span_edges(span: DataFrame, bins) -> DataFrame:
    each = span.withColumn("bins", F.explode(F.array(*[F.lit(int(b)).cast("bigint") for b in bins])))
    each = each.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), "bins")))
    edge = F.when(F.col("i") == F.col("bins"), F.col("hi")).otherwise(
        F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("i") / F.col("bins")))
    return each.select("feature", "bins", "i", edge.alias("edge"))


def psi_from_edges(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """(feature, bins, psi) from value counts and bin edges."""
    edges = materialize(edges, "edges")
    below = counts_at(counts, edges.withColumnRenamed("edge", "value"), SAMPLES)
    return _psi_scores(edges, below, totals(counts, SAMPLES))


def _psi_scores(edges: DataFrame, below: DataFrame, sizes: DataFrame) -> DataFrame:
    """Half-open bins, the last one closed; a bin's count is the difference of the counts below its edges.

    All bin numbers share the one table of counts. Values outside the reference range are in no bin but stay
    in the denominator.
    """
    # at most one row per feature and distinct edge
    placed = edges.join(F.broadcast(below.withColumnRenamed("value", "edge")), ["feature", "edge"])
    w = Window.partitionBy("feature", "bins").orderBy("i")
    last = F.col("i") + 1 == F.col("bins")
    for s in SAMPLES:
        upper = F.when(last, F.lead(f"{s}_le").over(w)).otherwise(F.lead(f"{s}_lt").over(w))
        placed = placed.withColumn(f"{s}_in", upper - F.col(f"{s}_lt"))
    bins = placed.where("i < bins").join(F.broadcast(sizes), "feature")
    term = psi_term(F.col("ref_in") / F.col("ref_total"), F.col("ana_in") / F.col("ana_total"))
    return bins.groupBy("feature", "bins").agg(F.sum(term).alias("psi"))


def _wide_psi(ref: DataFrame, ana: DataFrame, columns, bins, edges: str) -> DataFrame:
    """PSI of columns with very many values: the values are scanned, never shuffled."""
    if edges == "width":
        # one row per column
        one = ref.agg(*[F.min(number(c)).alias(f"lo_{c}") for c in columns],
                      *[F.max(number(c)).alias(f"hi_{c}") for c in columns])
        cuts = _span_edges(one.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi"))
            for c in columns]))).where("lo is not null"), bins)
    else:
        cuts = _named_edges(wide_quantiles(ref, columns, [(i, b) for b in bins for i in range(b + 1)]))
    cuts = materialize(cuts, "edges")
    points: dict[str, list[float]] = {}
    for r in cuts.select("feature", "edge").distinct().collect():  # at most the grid per column
        points.setdefault(r["feature"], []).append(r["edge"])
    below = scan_counts_at({"ref": ref, "ana": ana}, points)
    counted = [df.agg(*[F.count(number(c)).alias(c) for c in points]).unpivot([], list(points), "feature", f"{s}_total")
               for s, df in (("ref", ref), ("ana", ana))]
    return _psi_scores(cuts, below, counted[0].join(counted[1], "feature"))


def psi(ref: DataFrame, ana: DataFrame, columns=DRIFT_NUMERICAL, bins: int = 50, edges: str = "quantiles",
        many_values: int = MANY_VALUES) -> DataFrame:
    """(feature, psi_score) with one number of bins for all columns; ``edges`` is 'quantiles' or 'width'."""
    return psi_sweep(ref, ana, columns, [bins], edges, None, many_values).select(
        "feature", F.col("psi").alias("psi_score"))


def psi_sweep(ref: DataFrame, ana: DataFrame, columns=DRIFT_NUMERICAL, bins=range(5, 51), edges: str = "quantiles",
              counts: DataFrame | None = None, many_values: int = MANY_VALUES) -> DataFrame:
    """(feature, bins, psi) for every number of bins.

    Columns whose distinct values would make a large shuffle are sketched and scanned instead, with the same
    result. ``counts`` are the value counts of both samples if they are at hand.
    """
    bins = [int(b) for b in bins]
    make = {"quantiles": quantile_edges, "width": width_edges}[edges]
    if counts is not None:
        return psi_from_edges(counts, make(counts, bins))
    few, wide = split_by_distinct(ref, columns, many_values)
    parts = []
    if few:
        counts = sample_counts(ref, ana, few)
        parts.append(psi_from_edges(counts, make(counts, bins)))
    if wide:
        parts.append(_wide_psi(ref, ana, wide, bins, edges))
    return reduce(DataFrame.unionByName, parts)


def knee_bins(sweep: DataFrame, sensitivity: float = 1.0) -> DataFrame:
    """(feature, bins): the knee of the sweep curve taken as concave and decreasing; else the largest score.

    Follows Satopaa et al., "Finding a 'Kneedle' in a Haystack" (2011). The curve is scaled to the unit
    square and reversed; after a local maximum of (curve - x) the threshold is that maximum less the mean
    step in x, and a local minimum resets it to 0. The knee is the maximum in force where the next value
    first falls below the threshold. A feature has as many rows as the sweep has bin numbers.
    """
    each = Window.partitionBy("feature")
    by_bins = each.orderBy("bins")
    unit = lambda c: F.try_divide(F.col(c) - F.min(c).over(each), F.max(c).over(each) - F.min(c).over(each))
    scaled = sweep.select(
        "feature", "bins", "psi", unit("bins").alias("x"), unit("psi").alias("y"),
        F.row_number().over(by_bins).alias("pos"),
        F.row_number().over(each.orderBy(F.desc("bins"))).alias("mirror"), F.count(F.lit(1)).over(each).alias("n"))
    # reversing the curve puts the y (and, for the answer, the bins) of the mirror row on each row
    flipped = scaled.select("feature", "bins", F.col("y").alias("ry"), F.col("mirror").alias("pos"))
    curve = (scaled.select("feature", "x", "pos", "n").join(flipped, ["feature", "pos"])
             .withColumn("d", F.col("ry") - F.col("x")))
    walk = each.orderBy("pos")
    before, after = F.coalesce(F.lag("d").over(walk), F.col("d")), F.coalesce(F.lead("d").over(walk), F.col("d"))
    is_max = (F.col("d") >= before) & (F.col("d") >= after)
    is_min = (F.col("d") <= before) & (F.col("d") <= after)
    step = 1 / (F.col("n") - 1)
    events = curve.select(
        "feature", "pos", "n", F.lead("d").over(walk).alias("next_d"),
        F.when(is_max, F.col("bins")).alias("peak"),
        F.when(is_min, F.lit(0.0)).when(is_max, F.col("d") - sensitivity * step).alias("threshold"))
    so_far = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = events.select(
        "feature", "pos", "next_d", F.last("peak", ignorenulls=True).over(so_far).alias("peak"),
        F.last("threshold", ignorenulls=True).over(so_far).alias("threshold"))
    knees = (state.where("peak is not null and next_d < threshold")
             .groupBy("feature").agg(F.min_by("peak", "pos").alias("knee")))
    top = sweep.groupBy("feature").agg(F.min_by("bins", F.struct(-F.col("psi"), F.col("bins"))).alias("top"))
    return top.join(knees, "feature", "left").select("feature", F.coalesce("knee", "top").alias("bins"))


def psi_report(ref: DataFrame, ana: DataFrame, columns=DRIFT_NUMERICAL, bins=range(5, 51)) -> DataFrame:
    """(feature, bins, psi_score) at each feature's knee."""
    sweep = materialize(psi_sweep(ref, ana, columns, bins), "sweep")
    return sweep.join(knee_bins(sweep), ["feature", "bins"]).select("feature", "bins", F.col("psi").alias("psi_score"))


def drift_decision(scores: DataFrame, limit: float = PSI_LIMIT) -> DataFrame:
    """Mark each feature drifted or stable; retraining is due if any drifted. One row per feature."""
    marked = scores.select("feature", "psi_score", (F.col("psi_score") > limit).alias("drifted"))
    return marked.withColumn("trigger_retraining", F.max("drifted").over(Window.partitionBy(F.lit(1))))


# Two-sample tests

def ks_two_sample(counts: DataFrame, limit: float = TEST_LIMIT) -> DataFrame:
    """(feature, ks_stat, p_value, drifted) from the largest distance of the running shares."""
    run = running_counts(counts, SAMPLES).join(F.broadcast(totals(counts, SAMPLES)), "feature")
    gap = F.abs(F.col("ref_to") / F.col("ref_total") - F.col("ana_to") / F.col("ana_total"))
    one = run.groupBy("feature").agg(F.max(gap).alias("ks_stat"), F.first("ref_total").alias("n"),
                                     F.first("ana_total").alias("m"))
    p = ks_p_value(F.col("ks_stat"), F.col("n"), F.col("m"))
    return one.select("feature", "ks_stat", p.alias("p_value")).withColumn("drifted", F.col("p_value") < limit)


def wasserstein_normed(counts: DataFrame, limit: float = TEST_LIMIT) -> DataFrame:
    """(feature, distance, drifted): area between the running shares over the reference's deviation."""
    total = totals(counts, SAMPLES)
    run = running_counts(counts, SAMPLES).join(F.broadcast(total), "feature")
    gap = F.abs(F.col("ref_to") / F.col("ref_total") - F.col("ana_to") / F.col("ana_total"))
    area = run.groupBy("feature").agg(F.sum(gap * (F.col("next_value") - F.col("value"))).alias("area"))
    mean = (counts.groupBy("feature").agg((F.sum(F.col("value") * F.col("ref")) / F.sum("ref")).alias("mean")))
    spread = counts.join(F.broadcast(mean), "feature").groupBy("feature").agg(
        F.sqrt(F.sum(F.pow(F.col("value") - F.col("mean"), 2) * F.col("ref")) / F.sum("ref")).alias("std"))
    distance = F.col("area") / F.when(F.col("std") < 0.001, F.lit(0.001)).otherwise(F.col("std"))
    return area.join(spread, "feature").select("feature", distance.alias("distance")).withColumn(
        "drifted", F.col("distance") >= limit)


def drift_tests(counts: DataFrame, limit: float = TEST_LIMIT, small: int = 1000) -> DataFrame:
    """(feature, method, score, drifted): KS p-value up to ``small`` reference rows, else Wasserstein."""
    sizes = totals(counts, ["ref"]).collect()  # one row per feature
    few = [r["feature"] for r in sizes if r["ref_total"] <= small]
    many = [r["feature"] for r in sizes if r["ref_total"] > small]
    ks = ks_two_sample(counts.where(F.col("feature").isin(few)), limit).select(
        "feature", F.lit("ks").alias("method"), F.col("p_value").alias("score"), "drifted")
    ws = wasserstein_normed(counts.where(F.col("feature").isin(many)), limit).select(
        "feature", F.lit("wasserstein").alias("method"), F.col("distance").alias("score"), "drifted")
    if few and many:
        return ks.unionByName(ws)
    return ks if few else ws


def two_sample_tests(ref: DataFrame, ana: DataFrame, columns=DRIFT_NUMERICAL, limit: float = TEST_LIMIT,
                     small: int = 1000, many_values: int = MANY_VALUES) -> DataFrame:
    """:func:`drift_tests` of two samples; columns with more than ``many_values`` distinct values are not shuffled."""
    columns = list(columns)
    few, wide = split_by_distinct(ref.select(*columns).unionByName(ana.select(*columns)), columns, many_values)
    parts = [drift_tests(sample_counts(ref, ana, few), limit, small)] if few else []
    if wide:
        found = wide_two_sample(ref, ana, wide)
        distance = F.col("area") / F.when(F.col("std") < 0.001, F.lit(0.001)).otherwise(F.col("std"))
        p = ks_p_value(F.col("ks_stat"), F.col("n"), F.col("m"))
        is_small = F.col("n") <= small
        parts.append(found.select(
            "feature", F.when(is_small, "ks").otherwise("wasserstein").alias("method"),
            F.when(is_small, p).otherwise(distance).alias("score"),
            F.when(is_small, p < limit).otherwise(distance >= limit).alias("drifted")))
    return reduce(DataFrame.unionByName, parts)


def dataset_drift_share(tests: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """One row: number and share of drifted columns and whether the whole dataset drifted."""
    return tests.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted")).withColumn(
        "drift_share", F.col("n_drifted") / F.col("n_columns")).withColumn(
        "dataset_drift", F.col("drift_share") >= share)


# Categories by chunk

def js_distances(parts: DataFrame, reference: DataFrame, by) -> DataFrame:
    """(by.., feature, distance): Jensen-Shannon distance, base 2, of each group from the reference.

    ``parts`` holds (by.., feature, value, n), ``reference`` is a stored table (feature, value, share). A value
    only the reference has adds half its share, so those values enter as one difference and are never listed.
    A value that occurs in every group is frequent in the reference as well, and its share is broadcast.
    """
    by = list(by)
    size = parts.groupBy(*by, "feature").agg(F.sum("n").alias("size"))
    item = F.concat_ws("\u0001", "feature", "value").alias("item")
    known = reference.select(item, F.col("share").alias("q"))
    shares = join_lookup(parts.join(size, [*by, "feature"]).select(*by, "feature", "n", "size", item), known, "item",
                         "item", share="q")
    p, q = F.col("n") / F.col("size"), F.coalesce("q", F.lit(0.0))
    one = shares.select(*by, "feature", p.alias("p"), q.alias("q")).groupBy(*by, "feature").agg(
        (F.sum(half_kl(F.col("p"), F.col("q")) + half_kl(F.col("q"), F.col("p"))) + (1 - F.sum("q")) / 2).alias("js"))
    return one.select(*by, "feature", F.sqrt(F.when(F.col("js") > 0, F.col("js")).otherwise(0.0)).alias("distance"))


def js_categorical_chunks(ref: DataFrame, ana: DataFrame, columns=DRIFT_CATEGORICAL, chunk_size: int = 1000,
                          order_by=(EVENT_TIME, KEY), limit: float = JS_LIMIT,
                          partitions: int | None = None) -> DataFrame:
    """Distance of every chunk of the analysis rows, in the given order, from the whole reference.

    ``partitions`` is the number of sorted ranges, by default the session's shuffle partitions.
    """
    columns, order_by = list(columns), list(order_by)
    reference = materialize(shares_of(category_counts(ref, columns)), "shares")
    rows = with_row_index(ana.select(*order_by, *[c for c in columns if c not in order_by]), order_by,
                          partitions=partitions)
    rows = rows.withColumn("chunk_index", F.expr(f"row_index div {int(chunk_size)}"))
    ends = rows.groupBy("chunk_index").agg(F.min("row_index").alias("start_index"), F.max("row_index").alias("end_index"))
    long = (rows.select("chunk_index", *[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot(["chunk_index"], columns, "feature", "value").where("value is not null"))
    parts = long.groupBy("chunk_index", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    scored = js_distances(parts, reference, ["chunk_index"]).join(ends, "chunk_index")
    return scored.select("feature", "chunk_index", "start_index", "end_index", F.lit("jensen_shannon").alias("method"),
                         "distance", F.lit(limit).alias("upper_threshold"),
                         (F.col("distance") > limit).alias("alert"))


def widen_chunks(chunks: DataFrame, columns=DRIFT_CATEGORICAL) -> DataFrame:
    """One row per chunk with a value and alert column per feature."""
    return chunks.groupBy("chunk_index", "start_index", "end_index").pivot("feature", list(columns)).agg(
        F.first("distance").alias("value"), F.first("alert").alias("alert"))


# Principal components

def pca_loadings(ref_scaled: DataFrame, columns, k: int = 2) -> list[list[float]]:
    """k loading vectors of the scaled reference, rows with gaps included; the largest entry of each is made positive."""
    columns = list(columns)
    data = pattern_moments(ref_scaled, columns)
    return _loadings(ref_scaled, columns, k, data, fit_covariance(data)[1] if data.gaps else None)


def _loadings(ref_scaled: DataFrame, columns, k: int, data: Moments, cov) -> list[list[float]]:
    if data.gaps:
        return components(cov, k)
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(ref_scaled.select(*columns))
    pc = PCA(k=k, inputCol="v", outputCol="pc").fit(vectors).pc.toArray()
    out = []
    for j in range(k):
        w = pc[:, j]
        out.append([float(x) for x in w * (1.0 if w[abs(w).argmax()] > 0 else -1.0)])
    return out


def project(scaled: DataFrame, columns, loadings) -> DataFrame:
    terms = lambda w: reduce(lambda a, b: a + b, [F.col(c) * F.lit(x) for c, x in zip(columns, w)])
    return scaled.select(*[terms(w).alias(f"PC{j + 1}") for j, w in enumerate(loadings)])


def pca_psi(ref: DataFrame, ana: DataFrame, columns=DRIFT_NUMERICAL, k: int = 2, bins: int = 50,
            limit: float = PSI_LIMIT) -> DataFrame:
    """(component, psi_score, drifted, ref_gaps, ana_gaps): PSI of both samples on the reference's principal components.

    Rows with missing values take part with their expected scores (:mod:`txnlens.operators.gappy_pca`); the last two
    columns tell how many there are.
    """
    columns = list(columns)
    stats = {r["feature"]: (r["mean"], r["std"]) for r in fit_standard(ref, columns).collect()}
    ref_scaled, ana_scaled = apply_standard(ref, stats, columns), apply_standard(ana, stats, columns)
    seen = [pattern_moments(df, columns) for df in (ref_scaled, ana_scaled)]
    if seen[0].gaps or seen[1].gaps:
        mean, cov = fit_covariance(seen[0])
        loadings = _loadings(ref_scaled, columns, k, seen[0], cov)
        projected = [project_expected(df, columns, loadings, mean, cov, m.present)
                     for df, m in zip((ref_scaled, ana_scaled), seen)]
    else:
        loadings = _loadings(ref_scaled, columns, k, seen[0], None)
        projected = [project(df, columns, loadings) for df in (ref_scaled, ana_scaled)]
    scores = psi(*projected, [f"PC{j + 1}" for j in range(k)], bins)
    return scores.select(F.col("feature").alias("component"), "psi_score", (F.col("psi_score") > limit).alias("drifted"),
                         F.lit(seen[0].gaps).cast("bigint").alias("ref_gaps"),
                         F.lit(seen[1].gaps).cast("bigint").alias("ana_gaps"))
