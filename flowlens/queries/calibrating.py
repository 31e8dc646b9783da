"""Score ranking and threshold calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import binary_label
from flowlens.operators.calibration import (
    best_threshold,
    calibrate_grid,
    cross_fitted,
    ranked_grid,
    threshold_candidates,
)
from flowlens.operators.clustering import distance_to_centroid, mean_centroids
from flowlens.operators.evaluation import evaluate_at_threshold, score_stats
from flowlens.operators.ranking import auc, rank_truth, ranked_quantiles, roc_curve, score_quantiles
from flowlens.queries.registry import BENIGN_FLOW, calibration_part, flows, held_out_part, query, scored, table

RATES = ["precision", "recall", "f1", "fpr", "accuracy"]
PROBABILITIES = ", ".join(f"(CAST({p} AS DOUBLE))" for p in K.QUANTILES)


def quantile_sql(source: str) -> str:
    return f"""SELECT probability, min(score) AS quantile FROM
    (SELECT score, row_number() OVER (ORDER BY score) AS k, count(*) OVER () AS n FROM {source} WHERE truth = 0) r,
    (VALUES {PROBABILITIES}) v(probability) WHERE k >= ceil(probability * n) GROUP BY probability"""


def candidate_sql(source: str) -> str:
    last = K.GRID_POINTS - 1
    return f"""SELECT quantile AS threshold FROM ({quantile_sql(source)}) q
    UNION SELECT CASE WHEN i = {last} THEN hi ELSE i * ((hi - lo) / CAST({last} AS DOUBLE)) + lo END FROM
        (SELECT arg_min(quantile, probability) AS lo, arg_max(quantile, probability) AS hi
         FROM ({quantile_sql(source)}) q2) e, range({K.GRID_POINTS}) g(i)"""


METRICS = """CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall,
    CASE WHEN fp + tn > 0 THEN fp / CAST(fp + tn AS DOUBLE) ELSE 0 END AS fpr,
    CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) ELSE 0 END AS accuracy"""


def grid_sql(source: str) -> str:
    return f"""SELECT threshold, tp, fp, fn, tn, precision, recall, fpr, accuracy,
        CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM (SELECT *, {METRICS} FROM (
        SELECT threshold, count(*) FILTER (score > threshold AND truth = 1) AS tp,
            count(*) FILTER (score > threshold AND truth = 0) AS fp,
            count(*) FILTER (score <= threshold AND truth = 1) AS fn,
            count(*) FILTER (score <= threshold AND truth = 0) AS tn
        FROM ({candidate_sql(source)}) c, {source} GROUP BY threshold) cells) m"""


BEST_SQL = f"SELECT * FROM ({grid_sql('@scored')}) g ORDER BY f1 DESC, fpr, threshold LIMIT 1"

ROC_SQL = """SELECT score, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
    pos, neg, CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
    FROM (SELECT score, count(*) FILTER (truth = 1) AS pos, count(*) FILTER (truth = 0) AS neg
          FROM {source} GROUP BY score) c WINDOW w AS (ORDER BY score DESC)"""


def auc_sql(source: str) -> str:
    roc = ROC_SQL.format(source=source)
    return f"SELECT sum(neg * (tp - pos + pos / CAST(2 AS DOUBLE))) / max(all_pos * all_neg) AS auc_roc FROM ({roc}) r"


def rounded(cols):
    return "".join(f", round({c}, 9) AS {c}" for c in cols)


def benign_quantiles(rows):
    return score_quantiles(rows.where("truth = 0"), "score", rel_err=0)


@query("score_quantiles", quantile_sql("@scored"))
def score_quantiles_query(spark, sf):
    """Exact quantiles of the benign scores."""
    return benign_quantiles(scored(spark, sf))


@query(
    "score_quantiles_error",
    f"""SELECT probability, count(*) FILTER (truth = 0) AS benign, TRUE AS within
    FROM @scored, (VALUES {PROBABILITIES}) v(probability) GROUP BY probability""",
)
def score_quantiles_error(spark, sf):
    """The sketched quantiles lie within the promised rank error of the exact ones."""
    benign = scored(spark, sf).where("truth = 0")
    rough = {r.probability: r.quantile for r in score_quantiles(benign, "score").collect()}
    s, entries = F.col("score"), []
    counts = benign.agg(
        F.count("score").alias("n"),
        *[F.count_if(s <= F.lit(q)).alias(f"to_{i}") for i, q in enumerate(rough.values())],
        *[F.count_if(s < F.lit(q)).alias(f"below_{i}") for i, q in enumerate(rough.values())],
    )
    for i, p in enumerate(rough):
        n, slack = F.col("n"), F.ceil(F.col("n") * F.lit(K.QUANTILE_ERROR)) + 1
        within = (F.col(f"to_{i}") >= p * n - slack) & (F.col(f"below_{i}") <= p * n + slack)
        entries.append(F.struct(F.lit(p).alias("probability"), n.alias("benign"), within.alias("within")))
    return counts.select(F.inline(F.array(*entries)))


@query("threshold_candidates", candidate_sql("@scored"))
def threshold_candidates_query(spark, sf):
    return threshold_candidates(benign_quantiles(scored(spark, sf)))


def grid(rows):
    return calibrate_grid(rows, threshold_candidates(benign_quantiles(rows)), "score", "truth")


@query("calibrate_grid", f"SELECT threshold, tp, fp, fn, tn{rounded(RATES)} FROM ({grid_sql('@scored')}) g")
def calibrate_grid_query(spark, sf):
    found = grid(scored(spark, sf))
    return found.select("threshold", "tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in RATES])


@query("calibrate_best", f"SELECT threshold, tp, fp, fn, tn{rounded(RATES)} FROM ({BEST_SQL}) b")
def calibrate_best(spark, sf):
    """The threshold with the highest F1 over candidates from the benign scores."""
    best = best_threshold(grid(scored(spark, sf)))
    return best.select("threshold", "tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in RATES])


HELD_OUT_SQL = f"""WITH best AS (SELECT threshold FROM ({grid_sql('@calibration')}) g ORDER BY f1 DESC, fpr, threshold LIMIT 1),
    cells AS (SELECT threshold, count(*) FILTER (score > threshold AND truth = 1) AS tp,
        count(*) FILTER (score > threshold AND truth = 0) AS fp,
        count(*) FILTER (score <= threshold AND truth = 1) AS fn,
        count(*) FILTER (score <= threshold AND truth = 0) AS tn FROM @held_out, best GROUP BY threshold),
    rates AS (SELECT *, {METRICS} FROM cells),
    full_rates AS (SELECT *, CASE WHEN precision + recall > 0
        THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM rates)
    SELECT threshold, tp, fp, fn, tn, tp + fp + fn + tn AS total_records{rounded(RATES)},
        round(auc_roc, 9) AS auc_roc FROM full_rates, ({auc_sql('@held_out')}) a"""


@query("evaluate_at_threshold", HELD_OUT_SQL)
def evaluate_at_threshold_query(spark, sf):
    """Calibrated on the first days, reported on the days after."""
    rows = scored(spark, sf)
    ranking = rank_truth(calibration_part(rows), "score", "truth")
    candidates = threshold_candidates(ranked_quantiles(ranking))
    threshold = best_threshold(ranked_grid(ranking, candidates)).first()["threshold"]
    report = evaluate_at_threshold(held_out_part(rows), threshold, "score", "truth")
    return report.select(
        "threshold", "tp", "fp", "fn", "tn", "total_records", *[F.round(c, 9).alias(c) for c in [*RATES, "auc_roc"]]
    )


FOLDS = 3
CUTS = [3.217, 6.043, 9.511, 12.37, 15.83, 20.19, 24.77]

CROSSFIT_SQL = f"""WITH f AS (SELECT l_orderkey % {FOLDS} AS fold, l_linenumber % 2 AS side, l_quantity AS q, l_tax AS t,
        CASE WHEN label = '{BENIGN_FLOW}' THEN 0 ELSE 1 END AS truth FROM @flows),
    m AS (SELECT o.fold, side, avg(q) AS mq, avg(t) AS mt FROM range({FOLDS}) o(fold) JOIN f ON f.fold <> o.fold
        WHERE truth = 0 GROUP BY o.fold, side),
    s AS (SELECT truth, sqrt((q - mq) * (q - mq) + (t - mt) * (t - mt)) AS score FROM f JOIN m
        ON f.fold = m.fold AND f.side = m.side)
    SELECT threshold, count(*) FILTER (score > threshold AND truth = 1) AS tp,
        count(*) FILTER (score > threshold AND truth = 0) AS fp,
        count(*) FILTER (score <= threshold AND truth = 1) AS fn,
        count(*) FILTER (score <= threshold AND truth = 0) AS tn
    FROM s, (VALUES {", ".join(f"(CAST({c} AS DOUBLE))" for c in CUTS)}) c(threshold) GROUP BY threshold"""


@query("calibrate_crossfit", CROSSFIT_SQL)
def calibrate_crossfit(spark, sf):
    """Confusion counts of fixed thresholds, each order scored by the centres of two groups of
    the benign rows of the other folds."""
    rows = flows(spark, sf).select(
        (F.col("l_orderkey") % FOLDS).cast("int").alias("fold"),
        F.array("l_quantity", "l_tax").cast("array<double>").alias("x"),
        binary_label(F.col("label"), BENIGN_FLOW).alias("truth"),
        (F.col("l_linenumber") % 2).cast("int").alias(K.CLUSTER),
    )

    def fit(part):
        return mean_centroids(part.where("truth = 0"), "x", K.CLUSTER)

    def distances(centre, part):
        return distance_to_centroid(part, centre, "x")

    grid = calibrate_grid(cross_fitted(rows, fit, distances, FOLDS), CUTS, K.SCORE, "truth")
    return grid.select("threshold", "tp", "fp", "fn", "tn")


@query(
    "roc_curve",
    f"""SELECT score, tp, fp, round(tp / all_pos, 9) AS tpr, round(fp / all_neg, 9) AS fpr
    FROM ({ROC_SQL.format(source="@scored")}) r""",
)
def roc_curve_query(spark, sf):
    curve = roc_curve(scored(spark, sf), "score", "truth")
    return curve.select("score", "tp", "fp", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@query("auc_exact", f"SELECT round(auc_roc, 9) AS auc_roc FROM ({auc_sql('@scored')}) a")
def auc_exact(spark, sf):
    return auc(scored(spark, sf), "score", "truth").select(F.round("auc_roc", 9).alias("auc_roc"))


LABEL_PAIR_SQL = "(SELECT 1 - quality AS score, toxic AS truth FROM labels)"


@query("auc_binary_score", f"SELECT round(auc_roc, 9) AS auc_roc FROM ({auc_sql(LABEL_PAIR_SQL)}) a")
def auc_binary_score(spark, sf):
    """AUC of a score with two values, where nearly all pairs tie."""
    pair = table(spark, sf, "labels").select((1 - F.col("quality")).alias("score"), F.col("toxic").alias("truth"))
    return auc(pair, "score", "truth").select(F.round("auc_roc", 9).alias("auc_roc"))


@query(
    "score_stats",
    """SELECT round(avg(score), 8) AS mean_dist, round(stddev_samp(score), 8) AS std_dist, min(score) AS min_dist,
        max(score) AS max_dist FROM @scored""",
)
def score_stats_query(spark, sf):
    stats = score_stats(scored(spark, sf), "score")
    return stats.withColumns({c: F.round(c, 8) for c in ("mean_dist", "std_dist")})
