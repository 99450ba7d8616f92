"""Comment texts to clusters with their most typical members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import text as tx
from fieldtide.operators import clustering as cl
from fieldtide.operators import text as tt
from fieldtide.operators.latent import latent_axes
from fieldtide.session import stored


def reason_clusters(
    comments: DataFrame, id_col: str, text_col: str, ks: Sequence[int] = tuple(range(10, 20)), restarts: int = 10,
    dim: int = 256, n: int = 10, lemmas: DataFrame | None = None, latent: int | None = None,
) -> DataFrame:
    """Clean, lemmatize, embed, sweep k, take the elbow, and list the ``n`` nearest texts per cluster.

    Texts are embedded as ``dim`` hashed words, or on the ``latent`` strongest axes of their words.
    """
    # Comments are short, so a few input files hold very many: they are dealt to all cores, and each step is stored for the
    # passes that follow.
    cores = comments.sparkSession.sparkContext.defaultParallelism
    dealt = comments.repartition(max(cores, comments.rdd.getNumPartitions()))
    clean = stored(dealt.withColumn("cleaned", tx.clean_text(F.col(text_col))), "clean-comments")
    words = stored(tt.lemmatize(clean, "cleaned", lemmas, key=id_col), "lemmatized-comments")
    if latent:
        vectors = latent_axes(words, "lemmatized", latent).vectors(words, "lemmatized")
    else:
        vectors = cl.embed_text(words, "lemmatized", dim)
    # The vectors are read by every later step.
    vectors = stored(vectors, "comment-vectors")
    table, models = cl.kmeans_sweep(vectors, ks, restarts, id_col=id_col)
    k = cl.knee_point(table).first()["knee"] or max(models)
    near = cl.centroid_distance(vectors, cl.centers_table(comments.sparkSession, models[int(k)]), "features")
    top = cl.nearest_members(near, n, id_col=id_col)
    return top.select("cluster_id", "member_no", id_col, text_col, "center_dist")
