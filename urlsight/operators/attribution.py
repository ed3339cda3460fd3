"""Model attribution by permutation importance (E5)."""
from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .metrics import auc_metrics, curve, log_loss
from .score import class_scores


def permutation_importance(model, assembled: DataFrame, key: str, feature_names: list[str],
                           label_col: str = "label") -> DataFrame:
    """E5: ROC-AUC and log-loss increase when one feature is replaced by the
    value of a donor row (a fixed permutation of the rows).

    ``assembled`` must be a bounded sample with its ``sample_rank`` (``split.hash_sample``): one copy per feature is scored.
    """
    base = written(assembled.select(key, "sample_rank", F.col(label_col).cast("int").alias("y"), vector_to_array("features").alias("x")))
    n = base.count()
    # the row that stands next in the sample's hash order, the first after the last: a fixed permutation
    donors = base.select(F.when(F.col("sample_rank") == 1, F.lit(n)).otherwise(F.col("sample_rank") - 1).alias("sample_rank"), F.col("x").alias("xd"))
    paired = base.join(donors, "sample_rank")
    k = len(feature_names)
    names = F.array(*[F.lit(n) for n in feature_names])
    # one task for each feature: the sample itself comes out of its top-k in one partition
    copies = paired.select(key, "y", "x", "xd", F.explode(F.sequence(F.lit(-1), F.lit(k - 1))).alias("j")).repartition(k + 1, "j")
    xj = F.transform(F.col("x"), lambda v, i: F.when(i == F.col("j"), F.col("xd")[i]).otherwise(v))
    feats = copies.select(key, "y", F.when(F.col("j") < 0, F.lit("__baseline__"))
                          .otherwise(F.element_at(names, F.col("j") + 1)).alias("model"),
                          array_to_vector(xj).alias("features"))
    pred = class_scores(model.transform(feats))
    scored = written(pred.select("model", "y", F.coalesce("p", "margin").alias("p"), F.col("p").isNotNull().alias("has_p")))
    m = auc_metrics(curve(scored)).join(log_loss(scored.where("has_p")), "model", "left")
    basel = m.where(F.col("model") == "__baseline__").select(
        F.col("roc_auc").alias("_auc0"), F.col("log_loss").alias("_ll0"))
    return m.where(F.col("model") != "__baseline__").crossJoin(F.broadcast(basel)).select(
        F.col("model").alias("feature"), (F.col("_auc0") - F.col("roc_auc")).alias("auc_drop"),
        (F.col("log_loss") - F.col("_ll0")).alias("log_loss_increase"))
