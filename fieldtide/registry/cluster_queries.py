"""Clusters of vectors, and one-hot columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldtide.operators import clustering as cl
from fieldtide.operators import features
from fieldtide.operators.latent import latent_axes
from fieldtide.plans.clusters import reason_clusters
from fieldtide.registry.core import query

DIMS_SQL = "dims as (select vec_id, label, unnest(range(1, len(embedding) + 1)) d, unnest(embedding)::double v from embeddings)"
MEANS_SQL = DIMS_SQL + ", means as (select label, d, avg(v) m, count(*) n from dims group by 1, 2)"
SSE_SQL = MEANS_SQL + ", sse as (select x.label, count(distinct vec_id) members, sum((v - m) ** 2) sse from dims x join means m on x.label = m.label and x.d = m.d group by 1)"


@query("cluster_counts", "select label, count(*) members from embeddings group by 1")
def counts(t):
    return cl.cluster_counts(t.table("embeddings"))


@query("cluster_sse", SSE_SQL + "---select * from sse", digits={"sse": 5})
def sse(t):
    return cl.cluster_sse(t.table("embeddings"))


@query("cluster_ch", SSE_SQL + """, total as (select d, avg(v) g from dims group by 1)
---select (select count(*) from sse) k, (select sum(members)::bigint from sse) n,
 ((select sum(n * (m - g) ** 2) from means join total using (d)) / ((select count(*) from sse) - 1))
 / ((select sum(sse) from sse) / ((select sum(members) from sse) - (select count(*) from sse))) ch""", digits={"ch": 5})
def ch(t):
    return cl.cluster_ch(t.table("embeddings"))


def silhouette_sql(distance: str) -> str:
    return f"""pairs as (select a.vec_id, a.label, b.label other, sum({distance}) s, count(*) n from embeddings a, embeddings b group by 1, 2, 3),
ab as (select vec_id, label, max(case when label = other then s / nullif(n - 1, 0) end) a, min(case when label <> other then s / n end) b from pairs group by 1, 2)
---select avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)) silhouette from ab"""


@query("cluster_silhouette", silhouette_sql("list_distance(a.embedding::double[], b.embedding::double[]) ** 2"), digits={"silhouette": 6})
def silhouette(t):
    return cl.cluster_silhouette(t.table("embeddings"))


@query("cluster_silhouette_euclidean", silhouette_sql("list_distance(a.embedding::double[], b.embedding::double[])"), digits={"silhouette": 6})
def silhouette_euclidean(t):
    return cl.cluster_silhouette(t.table("embeddings"), "euclidean")


NEAREST_SQL = MEANS_SQL + """, gaps as (select x.vec_id, m.label cluster_id, sqrt(sum((v - m) ** 2)) gap from dims x join means m on x.d = m.d group by 1, 2),
near as (select vec_id, arg_min(cluster_id, gap) cluster_id, min(gap) center_dist from gaps group by 1)"""


def near(t):
    rows = t.table("embeddings")
    return cl.centroid_distance(rows, cl.cluster_means(rows)).select("vec_id", "cluster_id", "center_dist")


@query("centroid_distance", NEAREST_SQL + "---select * from near", digits={"center_dist": 6})
def distances(t):
    return near(t)


@query("nearest_members", NEAREST_SQL + """---select vec_id, cluster_id, center_dist, n member_no from (select *, row_number() over
 (partition by cluster_id order by center_dist, vec_id) n from near) x where n <= 10""", digits={"center_dist": 6})
def members(t):
    return cl.nearest_members(near(t))


@query("knee_point", """pts as (select n_chars // 1000 k, count(*) c from documents group by 1),
norm as (select k, (k - min(k) over ()) / (max(k) over () - min(k) over ()) xn, (c - min(c) over ()) / (max(c) over () - min(c) over ()) yn from pts),
diff as (select k, xn, 1 - yn - xn d from norm),
near as (select *, lag(d) over w p, lead(d) over w q, xn - lag(xn) over w step from diff window w as (order by k)),
mark as (select *, d >= coalesce(p, d) and d >= coalesce(q, d) top, d <= coalesce(p, d) and d <= coalesce(q, d) low, avg(step) over () s from near),
run as (select *, last_value(case when low then 0 when top then d - s end ignore nulls) over w lim, last_value(case when top then k end ignore nulls) over w peak
 from mark window w as (order by k rows between unbounded preceding and current row))
---select arg_min(peak, k) knee from run where peak is not null and q < lim""")
def knee(t):
    points = t.table("documents").groupBy(F.expr("n_chars div 1000").alias("k")).agg(F.count(F.lit(1)).alias("sse"))
    return cl.knee_point(points)


DIM = 256
EMBED_SQL = f"""words as (select doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) w from fx_text),
tf as (select doc_id, ('0x' || md5(w)[:8])::bigint % {DIM} bucket, count(*) n from words group by 1, 2),
idf as (select bucket, ln(((select count(*) from fx_text) + 1) / (count(*) + 1)) weight from tf group by 1),
weighted as (select doc_id, bucket, n * weight v from tf join idf using (bucket))"""


@query("embed_text", EMBED_SQL + """---select doc_id, bucket, v / sqrt(sum(v * v) over (partition by doc_id)) weight from weighted where v > 0""",
       views=["fx_text"], digits={"weight": 8})
def embed(t):
    """All weights above zero of all texts."""
    rows = cl.embed_text(t.fx("fx_text"), "text", DIM).select("doc_id", vector_to_array("features").alias("v"))
    return rows.select("doc_id", F.posexplode("v").alias("bucket", "weight")).where("weight > 0").withColumn("bucket", F.col("bucket").cast("long"))


@query("latent_text")
def latent(t):
    """Places of all texts on the 16 strongest axes of their words; checked against a plain decomposition in the tests."""
    rows = t.fx("fx_text")
    return latent_axes(rows, "text", 16).vectors(rows, "text").select("doc_id", F.posexplode(vector_to_array("features")).alias("axis", "place"))


KS, RESTARTS, STEPS, TOL = range(10, 20), 10, 300, 1e-4


def lloyd_sql(ks) -> str:
    """All models step by step; ``final`` has the last centers, ``best`` the start that won for each k."""
    return f"""p as (select vec_id id, embedding::double[{WIDTH}] x from embeddings),
dim as (select id, unnest(range(1, {WIDTH + 1})) d, unnest(x::double[]) v from p),
first as (select s, x, row_number() over (partition by s order by md5(s || ':' || id), x) - 1 j from p, (select unnest(range({RESTARTS})) s) r),
lloyd as (select k, s, 0 it, j, x c, true moving from first, (select unnest([{', '.join(map(str, ks))}]) k) q where j < k
 union all select k, s, it, j, c, max(shift) over (partition by k, s) > {TOL * TOL} moving from (
  select l.k, l.s, l.it + 1 it, l.j, coalesce(m.c, l.c) c, coalesce(array_distance(m.c, l.c) ** 2, 0) shift from lloyd l left join (
   select k, s, j, list(v order by d)::double[{WIDTH}] c from (
    select k, s, j, d, avg(v) v from (select k, s, id, arg_min(j, {{'g': array_distance(x, c), 'j': j}}) j from lloyd, p where moving group by 1, 2, 3) a
    join dim using (id) group by 1, 2, 3, 4) n group by 1, 2, 3) m on m.k = l.k and m.s = l.s and m.j = l.j where l.moving and l.it < {STEPS}) o),
final as (select k, s, j, c from lloyd qualify it = max(it) over (partition by k, s)),
near as (select k, s, id, arg_min(j, {{'g': array_distance(x, c), 'j': j}}) j, min(array_distance(x, c)) ** 2 g from final, p group by 1, 2, 3),
costs as (select k, s, sum(g) sse from near group by 1, 2),
best as (select k, s, sse from costs qualify row_number() over (partition by k order by round(sse, 6), s) = 1)"""


WIDTH = 64

SWEEP_SQL = f"""member as (select k, near.s, id, j from near join best using (k, s)),
sums as (select k, j, d, sum(v) y from member join dim using (id) group by 1, 2, 3),
size as (select k, j, count(*) n, sum(q) squares from member join (select id, sum(v * v) q from dim group by 1) l using (id) group by 1, 2),
cluster as (select k, j, n, squares, list(y order by d)::double[{WIDTH}] y from sums join size using (k, j) group by 1, 2, 3, 4),
gaps as (select m.k, m.id, m.j own, c.j, c.n, array_inner_product(x, x) + c.squares / c.n - 2 * array_inner_product(x, c.y) / c.n g
 from member m join p using (id) join cluster c on c.k = m.k),
ab as (select k, id, max(case when j = own then n end) n, max(case when j = own then g * n / nullif(n - 1, 0) end) a, min(case when j <> own then g end) b from gaps group by 1, 2),
shape as (select k, avg(case when n > 1 then coalesce((b - a) / nullif(greatest(a, b), 0), 0) else 0 end) silhouette, count(*) n from ab group by 1),
held as (select f.k, f.j, c, coalesce(z.n, 0) n from final f join best on best.k = f.k and best.s = f.s left join size z on z.k = f.k and z.j = f.j),
middle as (select k, d, sum(n * v) / sum(n) m from (select k, j, n, unnest(range(1, {WIDTH + 1})) d, unnest(c::double[]) v from held) h group by 1, 2),
spread as (select k, sum(n * (v - m) ** 2) b from (select k, j, n, unnest(range(1, {WIDTH + 1})) d, unnest(c::double[]) v from held) h join middle using (k, d) group by 1),
used as (select k, count(*) filter (n > 0) u from held group by 1)"""


@query("kmeans_sweep", lloyd_sql(KS) + ", " + SWEEP_SQL + """---select k, sse, silhouette, (b / (u - 1)) / (sse / (n - u)) ch
 from best join shape using (k) join spread using (k) join used using (k)""", digits={"sse": 5, "silhouette": 6, "ch": 5}, recursive=True)
def sweep(t):
    """k from 10 to 19, ten starts each."""
    table, _ = cl.kmeans_sweep(t.table("embeddings"), KS, RESTARTS, STEPS, TOL, vec="embedding")
    return table


@query("assign_cluster_label", lloyd_sql([10]) + "---select id vec_id, j::bigint cluster_id from near join best using (k, s)", recursive=True)
def assign(t):
    rows = t.table("embeddings").select("vec_id", "embedding")
    _, models = cl.kmeans_sweep(rows, [10], RESTARTS, STEPS, TOL, vec="embedding")
    return cl.assign_cluster_label(models[10], rows, "embedding", "cluster_id").select("vec_id", "cluster_id")


@query("reason_clusters")
def clusters(t):
    return reason_clusters(t.fx("fx_comments"), "cmkey", "cmcomment")


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def one_hot_sql(values, column):
    return ", ".join(f"cast({column} = '{v}' as int) \"{column}_{v}\"" for v in values)


BAND = "case p_size % 3 when 0 then 'A-B' when 1 then 'A_B' else 'C' end"


@query("one_hot", f"""select p_partkey, p_type, band, {one_hot_sql([t for t in TYPES if t != 'PROMO'], 'p_type')}, cast(band = 'A-B' as int) "band_A_B",
 cast(band = 'A_B' as int) "band_A_B_2", cast(band = 'C' as int) "band_C" from (select p_partkey, p_type, {BAND} band from part) x""")
def one_hot(t):
    """Fitted on parts without PROMO, applied to all: PROMO is unseen. Two categories have one cleaned name."""
    parts = t.table("part").select("p_partkey", "p_type", F.expr(BAND).alias("band"))
    return features.one_hot(parts.where("p_type <> 'PROMO'"), ["p_type", "band"]).transform(parts)


@query("one_hot_vector", """cats as (select o_custkey::varchar v, row_number() over (order by o_custkey::varchar) - 1 i from (select distinct o_custkey from orders where o_custkey % 3 <> 0) x)
---select o_orderkey, i::bigint place, case when i is null then 0 else 1 end::double filled from orders left join cats on v = o_custkey::varchar""", digits={"filled": 0})
def one_hot_vectors(t):
    """Fitted on two thirds of the customers, which are far too many for columns; the others are all zeros."""
    rows = t.table("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    model = features.one_hot_vector(["customer"]).fit(rows.where(F.col("customer").cast("long") % 3 != 0))
    # The vectors are as long as there are customers: only their filled places are read.
    coded = model.transform(rows).select("o_orderkey", F.unwrap_udt("customer_vec").alias("v"))
    filled = F.aggregate("v.values", F.lit(0.0), lambda s, x: s + x)
    return coded.select("o_orderkey", F.get("v.indices", F.lit(0)).cast("long").alias("place"), filled.alias("filled"))
