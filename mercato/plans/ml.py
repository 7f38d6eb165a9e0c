"""Machine-learning jobs on executors: churn scoring and demand forecasting.

The reference trained scikit-learn / Prophet on the driver after ``toPandas()``.
Here the churn model is a Spark ML pipeline (distributed training and scoring)
and the baseline forecast is exact DataFrame work; the fitted one is in
``plans/forecast``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.numeric import round_half_up
from mercato.operators.ranking import global_rank
from mercato.plans.forecast import demand_forecast  # noqa: F401
from mercato.plans.metrics import class_report, exact_auc
from mercato.session import checkpoint_dir

NUMERIC = ["recency_days", "frequency", "lifetime_value", "avg_order_value", "r_score", "f_score", "m_score",
           "rfm_score", "customer_lifetime_days"]
CATEGORICAL = ["market_segment", "customer_region"]
CHURN_SEGMENTS = ["At Risk", "Needs Attention", "Lost"]


# -- churn (M1-M8) ---------------------------------------------------------------------

def churn_frame(rfm: DataFrame) -> DataFrame:
    """Training frame: features + label (segment in the churn set → 1)."""
    return rfm.select(
        "customer_key", "recency_days", "frequency", F.col("monetary").cast("double").alias("lifetime_value"),
        "avg_order_value", "r_score", "f_score", "m_score", "rfm_score", "customer_lifetime_days",
        "market_segment", "customer_region",
        F.when(F.col("rfm_segment").isin(*CHURN_SEGMENTS), 1).otherwise(0).alias("churn_label"))


def stratified_split(df: DataFrame, label: str, key: str, train_frac: float = 0.8,
                     seed: int = 42, **kw) -> tuple[DataFrame, DataFrame]:
    """Exact stratified split: per label, the first round(frac·n) rows in a
    seeded hash order go to training.  Ranked with the distributed ranking
    operator, so no label class is gathered in one task."""
    h = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    ranked, _ = global_rank(h, [(label, True), ("_h", True), (key, True)], "_r", **kw)
    per = ranked.groupBy(label).agg((F.min("_r") - 1).alias("_off"), F.count(F.lit(1)).alias("_n"))
    j = ranked.join(F.broadcast(per), label)  # one row per label value
    is_train = (F.col("_r") - F.col("_off")) <= F.round(F.col("_n") * F.lit(train_frac))
    j = j.withColumn("_train", is_train).drop("_h", "_r", "_off", "_n")
    return j.where("_train").drop("_train"), j.where(~F.col("_train")).drop("_train")


def spread(rows: DataFrame, key: str, rows_per_task: int = 250_000) -> DataFrame:
    """The rows stored once and dealt by ``key`` over all cores, and over more tasks when they are many.

    Fitting passes over its rows for every level of every tree, and a ranked frame may come in one partition.
    """
    spark = rows.sparkSession
    checkpoint_dir(spark)
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // rows_per_task))
    return rows.repartition(tasks, key).checkpoint(eager=True)


def fit_churn(train: DataFrame, seed: int = 42, max_iter: int = 100, max_depth: int = 5, step: float = 0.1) -> PipelineModel:
    """Scaled numbers and category codes into boosted trees.

    Codes follow the categories' alphabet; a category that training did not see, or none,
    has code -1.
    """
    train = spread(train, "customer_key")
    indexed = [StringIndexer(inputCol=c, outputCol=f"_{c}_idx", stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
               for c in CATEGORICAL]
    # the indexer gives what it does not know the number of its labels
    codes = ", ".join(f"CASE WHEN _{c}_idx >= {len(m.labels)} THEN -1.0 ELSE _{c}_idx END AS {c}_idx"
                      for c, m in zip(CATEGORICAL, indexed, strict=True))
    unknown = SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")
    num = VectorAssembler(inputCols=NUMERIC, outputCol="_num", handleInvalid="keep")
    scale = StandardScaler(inputCol="_num", outputCol="_num_scaled", withMean=True, withStd=True)
    feats = VectorAssembler(inputCols=["_num_scaled"] + [f"{c}_idx" for c in CATEGORICAL], outputCol="features")
    gbt = GBTClassifier(labelCol="churn_label", featuresCol="features", maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, seed=seed)
    return Pipeline(stages=[*indexed, unknown, num, scale, feats, gbt]).fit(train)


def risk_tier(p):
    """Right-closed bins (-0.01, 0.4] Low, (0.4, 0.6] Medium, (0.6, 0.8] High, (0.8, 1.01] Critical."""
    return (F.when(p <= 0.4, "Low").when(p <= 0.6, "Medium").when(p <= 0.8, "High")
            .when(p <= 1.01, "Critical"))


def score(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """gold_churn_scores: every customer scored on the executors."""
    out = model.transform(frame)
    p = round_half_up(vector_to_array("probability")[1], 4)
    return out.select("customer_key", "market_segment", "customer_region", "recency_days", "frequency",
                      "lifetime_value", "rfm_score", "churn_label",
                      F.col("prediction").cast("int").alias("churn_prediction"),
                      p.alias("churn_probability")).withColumn("risk_tier", risk_tier(F.col("churn_probability")))


def _predicted(model: PipelineModel, test: DataFrame) -> DataFrame:
    return model.transform(test).select("customer_key", "churn_label", F.col("prediction").cast("int").alias("prediction"),
                                        vector_to_array("rawPrediction")[1].alias("raw"))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """AUC (exact), accuracy, precision, recall, F1 (positive class) as one row."""
    pred = _predicted(model, test)
    auc = exact_auc(pred, "raw", "churn_label", "customer_key").first()["auc"]
    c = pred.agg(F.count_if((F.col("prediction") == 1) & (F.col("churn_label") == 1)).alias("tp"),
                 F.count_if((F.col("prediction") == 1) & (F.col("churn_label") == 0)).alias("fp"),
                 F.count_if((F.col("prediction") == 0) & (F.col("churn_label") == 1)).alias("fn"),
                 F.count_if((F.col("prediction") == 0) & (F.col("churn_label") == 0)).alias("tn"))
    prec = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    rec = F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return c.select(F.lit(auc).cast("double").alias("auc"),
                    ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))
                    .alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
                    (2 * prec * rec / F.nullif(prec + rec, F.lit(0))).alias("f1"), "tp", "fp", "fn", "tn")


def report(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and averages."""
    return class_report(_predicted(model, test), "churn_label", "prediction")


def feature_importance(model: PipelineModel) -> DataFrame:
    gbt = model.stages[-1]
    names = NUMERIC + CATEGORICAL
    imp = gbt.featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


def train_churn(rfm: DataFrame, seed: int = 42, **kw):
    """(model, train, test)."""
    frame = churn_frame(rfm)
    train, test = stratified_split(frame, "churn_label", "customer_key", seed=seed)
    return fit_churn(train, seed=seed, **kw), train, test


def stored_churn(rfm: DataFrame, folder: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, scores of all customers, test rows), trained once and kept at ``folder``.

    The folder is complete once the scores are there, which are written last.
    """
    spark = rfm.sparkSession
    model_path, test_path, scores_path = f"{folder}/model", f"{folder}/test", f"{folder}/scores"
    done = spark._jvm.org.apache.hadoop.fs.Path(scores_path, "_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        model, _, test = train_churn(rfm)
        model.write().overwrite().save(model_path)
        test.write.mode("overwrite").parquet(test_path)
        score(model, churn_frame(rfm)).write.mode("overwrite").parquet(scores_path)
    return PipelineModel.load(model_path), spark.read.parquet(scores_path), spark.read.parquet(test_path)


def rule_scores(rfm: DataFrame) -> DataFrame:
    """The columns of ``score`` by a plain rule: (15 - rfm_score) / 12, so 0 for the best scores and 1 for the worst."""
    p = round_half_up((F.lit(15.0) - F.col("rfm_score")) / F.lit(12.0), 4)
    return churn_frame(rfm).select(
        "customer_key", "market_segment", "customer_region", "recency_days", "frequency", "lifetime_value", "rfm_score",
        "churn_label", F.when(p > 0.5, 1).otherwise(0).alias("churn_prediction"), p.alias("churn_probability")) \
        .withColumn("risk_tier", risk_tier(F.col("churn_probability")))


# -- forecasting (M9-M11) ----------------------------------------------------------------

def forecast_input(monthly: DataFrame) -> DataFrame:
    """(region, ds, y): monthly revenue per region; y is an exact decimal."""
    return (monthly.groupBy("year_month", "region").agg(F.sum("net_revenue").alias("y"))
            .select("region", F.to_date(F.concat(F.col("year_month"), F.lit("-01"))).alias("ds"), "y"))


def baseline_forecast(series: DataFrame, horizon: int = 6) -> DataFrame:
    """Linear trend × month-of-year seasonal index, per region, exact sums.

    t = months since the region's first month; y in cents; the products that can
    exceed a bigint are decimals.
    slope b = (n·Σty − Σt·Σy) / (n·Σt² − (Σt)²), a = (Σy − b·Σt) / n;
    index s[m] = mean over month m of round(y / (a + b·t), 8);
    yhat = round((a + b·t) · s[m] / 100, 2) for history and ``horizon`` months.
    A series has one row a month; all steps are windows over the region's rows, which
    meet in one exchange.
    """
    region, month = Window.partitionBy("region"), Window.partitionBy("region", "_moy")
    s = (series.where(F.col("region").isNotNull())
         .withColumns({"_m": F.year("ds") * 12 + F.month("ds") - 1, "_yc": (F.col("y") * 100).cast("long")})
         .withColumns({"_m1": F.max("_m").over(region), "_t": F.col("_m") - F.min("_m").over(region)}))
    sums = {"_n": F.count(F.lit(1)), "_st": F.sum("_t"), "_sy": F.sum("_yc"), "_stt": F.sum(F.col("_t") * F.col("_t")),
            "_sty": F.sum(F.col("_t") * F.col("_yc"))}
    s = s.withColumns({name: total.over(region) for name, total in sums.items()})
    wide = "decimal(38,0)"
    big = [F.col(c).cast("decimal(18,0)") * F.col(d).cast("decimal(20,0)") for c, d in (("_n", "_sty"), ("_st", "_sy"))]
    s = s.withColumn("_b", (big[0].cast(wide) - big[1].cast(wide)).cast("double")
                     / F.nullif((F.col("_n") * F.col("_stt") - F.col("_st") * F.col("_st")).cast("double"), F.lit(0.0)))
    s = s.withColumn("_a", (F.col("_sy").cast("double") - F.col("_b") * F.col("_st").cast("double")) / F.col("_n").cast("double"))
    # the last month of a region brings the coming ones
    ahead = F.when(F.col("_m") == F.col("_m1"), F.sequence(F.lit(0), F.lit(horizon))).otherwise(F.array(F.lit(0)))
    s = s.withColumn("_k", F.explode(ahead)).withColumns({
        "ds": F.when(F.col("_k") == 0, F.col("ds")).otherwise(F.add_months(F.trunc("ds", "month"), F.col("_k"))),
        "_fit": F.col("_a") + F.col("_b") * (F.col("_t") + F.col("_k")).cast("double"),
        **{c: F.when(F.col("_k") == 0, F.col(c)) for c in ("y", "_yc")}})
    s = s.withColumns({"_moy": F.month("ds"), "_ratio": round_half_up(
        F.col("_yc").cast("double") / F.nullif(F.col("_fit"), F.lit(0.0)), 8).cast("decimal(20,8)")})
    index = F.sum("_ratio").over(month).cast("double") / F.nullif(F.count("_ratio").over(month).cast("double"), F.lit(0.0))
    return s.withColumn("_s", index).select(
        "region", "ds", F.col("y").cast("double").alias("y"),
        round_half_up(F.col("_fit") * F.col("_s") / F.lit(100.0), 2).alias("yhat"),
        F.when(F.col("_k") > 0, "forecast").otherwise("actual").alias("is_forecast"))


def forecast_mape(fc: DataFrame) -> DataFrame:
    """MAPE in percent per region over the actual rows."""
    a = fc.where(F.col("is_forecast") == "actual")
    ape = round_half_up(F.abs(F.col("y") - F.col("yhat")) / F.nullif(F.col("y"), F.lit(0.0)), 8).cast("decimal(20,8)")
    return a.groupBy("region").agg(round_half_up(
        F.sum(ape).cast("double") / F.count(ape).cast("double") * F.lit(100.0), 4).alias("mape_pct"))
