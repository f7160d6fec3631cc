"""Two-sided ranking: a gate score chooses the side, the side's own score ranks it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.ranking import rank_by_value

# Gate cut and the shares of each side that are predicted to leave.
GATE_CUT, TOP_POS, TOP_NEG = 0.35, 0.25, 0.10


def gate_rank_scores(
    df: DataFrame, gate: str = "gate", pos: str = "pos_score", neg: str = "neg_score", cut: float = GATE_CUT
) -> DataFrame:
    """Add ``side`` (1 above the cut) and ``fused``, the clipped score of the row's own side."""
    above = F.col(gate) >= cut
    own = F.when(above, F.col(pos)).otherwise(F.col(neg))
    return df.withColumn("side", above.cast("int")).withColumn(
        "fused", F.greatest(F.least(own, F.lit(1.0)), F.lit(0.0))
    )


def gate_rank_predict(
    df: DataFrame,
    key: str,
    gate: str = "gate",
    pos: str = "pos_score",
    neg: str = "neg_score",
    cut: float = GATE_CUT,
    top_pos: float = TOP_POS,
    top_neg: float = TOP_NEG,
) -> DataFrame:
    """Predict 1 for the best ``floor(share * size)`` rows of each side, ranked exactly."""
    above = F.col(gate) >= cut
    sided = df.withColumn("side", above.cast("int")).withColumn(
        "_own", F.when(above, F.col(pos)).otherwise(F.col(neg))
    )
    sizes = sided.agg(
        F.struct(F.count_if(above).alias("pos"), F.count_if(~above).alias("neg"))
    ).scalar()
    ranked = rank_by_value(sided, "_own", key, ["side"], descending=True, out="rank")
    allowed = F.when(F.col("side") == 1, F.floor(F.lit(top_pos) * sizes["pos"])).otherwise(
        F.floor(F.lit(top_neg) * sizes["neg"])
    )
    return ranked.withColumn("prediction", (F.col("rank") <= allowed).cast("int")).drop("_own")
