"""DuckDB SQL for the queries of this folder that SQL can express at the size of the tables."""

from tabsift.llm import licenses

TOP_K = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as t
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.t::double[], c.t::double[])::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.t) = len(c.t)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from pairs
qualify rank <= 5
"""

CENTROIDS = """
with kept as (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
    from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as (
    select row_number() over (order by sha256('1:' || vec_id), v) - 1 as k, v from kept
    qualify row_number() over (order by sha256('1:' || vec_id), v) <= 16
)""" + "".join(f""", a{i} as (
    select r, any_value(vec_id) as vec_id, any_value(v) as v, min({{'d': d, 'k': k}}) as best
    from (select kept.*, k, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
          from kept cross join c{i})
    group by r
), m{i} as (
    select k, list(floored order by p) as v
    from (select k, p, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) as floored
          from (select best.k as k, unnest(v) as x, generate_subscripts(v, 1) as p from a{i}) group by k, p)
    group by k
), c{i + 1} as (
    select c{i}.k, coalesce(m{i}.v::bigint[], c{i}.v) as v from c{i} left join m{i} on c{i}.k = m{i}.k
)""" for i in range(4)) + """
select vec_id, best.k::int as cluster, best.d as distance,
    sum(best.d) over (partition by best.k)::bigint as cluster_inertia, sum(best.d) over ()::bigint as inertia,
    sha256(array_to_string(c3.v, ',')) as centroid_sha256
from a3 join c3 on c3.k = best.k
"""

ORACLES: dict[str, str] = {"op4_top_k": TOP_K, "op10_licenses": licenses.oracle(), "op11_centroids": CENTROIDS}
