"""SMOTE oversampling (Chawla et al., JAIR 2002), reproducible and partition-independent.

Every class smaller than the largest is raised to its size. Class c needs
n_max - n_c synthetic points: every source row makes floor((n_max-n_c)/n_c)
copies and the first (n_max-n_c) mod n_c rows in md5(id:seed) order make one
more (the exact per-group selection of ``sampling``). Copy j of row x takes
neighbour number 1 + h mod k' among x's k' = min(k, n_c - 1) nearest
same-class points and a step u in [0, 1), both from h = md5(id:j:seed), and
becomes x + u * (nn - x), computed with ``zip_with`` on the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.columns import hex_prefix_int, key_hash
from orrery.operators.neighbors import knn_join
from orrery.operators.sampling import select_first_per_group

MAX_CLASSES = 100_000
COPIES = 10_000  # made from one row at once


def smote(df: DataFrame, label_col: str = "label", id_col: str = "id", vec_col: str = "vec",
          k: int = 5, seed: int = 42, knn: DataFrame | None = None, **knn_args) -> DataFrame:
    """Originals plus synthetic rows: (id, label, vec, is_synthetic, source_id,
    copy_no, neighbor_id); synthetic rows have a NULL id."""
    counts = df.groupBy(label_col).count().limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} classes")
    n_max = max(r["count"] for r in counts)
    plan = []
    for r in counts:
        n = r["count"]
        need = n_max - n
        if need > 0 and n < 2:
            raise ValueError(f"class {r[label_col]!r} has {n} row; SMOTE needs a neighbour")
        plan.append((r[label_col], need // n, need % n, min(k, n - 1)))
    spark = df.sparkSession
    lt = df.schema[label_col].dataType.simpleString()
    quota = spark.createDataFrame(plan, f"{label_col} {lt}, _base long, quota long, _kk int")
    base = df.select(id_col, label_col, F.col(vec_col).cast("array<double>").alias(vec_col))
    flagged = select_first_per_group(base, label_col, quota.select(label_col, "quota"), [id_col], seed)
    copies = (flagged.join(F.broadcast(quota), label_col)
                     .withColumn("_copies", F.col("_base") + F.col("_selected").cast("long"))
                     .where(F.col("_copies") > 0)
                     # in chunks, dealt out between: few rows may have very many copies
                     .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                F.floor((F.col("_copies") - 1) / COPIES))))
                     .repartition(id_col, "_chunk")
                     .withColumn("copy_no", F.explode(F.sequence(
                         F.col("_chunk") * COPIES,
                         F.least(F.col("_copies"), (F.col("_chunk") + 1) * COPIES) - 1)))
                     .withColumn("_h", key_hash([id_col, "copy_no"], seed))
                     .withColumn("rank", (1 + hex_prefix_int(F.col("_h"), 8) % F.col("_kk")).cast("int"))
                     .withColumn("_u", F.conv(F.substring("_h", 9, 13), 16, 10).cast("long")
                                 / F.lit(float(1 << 52))))
    nn = knn if knn is not None else knn_join(df, k, id_col, vec_col, group_col=label_col, **knn_args)
    nbr = base.select(F.col(id_col).alias("neighbor_id"), F.col(vec_col).alias("_nv"))
    syn = (copies.join(nn.select(id_col, "neighbor_id", "rank"), [id_col, "rank"])
                 .join(nbr, "neighbor_id")
                 .select(F.lit(None).cast(df.schema[id_col].dataType).alias(id_col), label_col,
                         F.zip_with(vec_col, "_nv", lambda a, b: a + F.col("_u") * (b - a)).alias(vec_col),
                         F.lit(True).alias("is_synthetic"), F.col(id_col).alias("source_id"),
                         "copy_no", "neighbor_id"))
    orig = base.select(id_col, label_col, vec_col, F.lit(False).alias("is_synthetic"),
                       F.col(id_col).alias("source_id"), F.lit(None).cast("long").alias("copy_no"),
                       F.lit(None).cast(df.schema[id_col].dataType).alias("neighbor_id"))
    return orig.unionByName(syn)
