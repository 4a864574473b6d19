"""DuckDB SQL that is made by a rule."""

from __future__ import annotations


def kmeans_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Plain rounds of assignment and floor means. Doubles hold these integers exactly."""
    dist = "list_sum(list_transform(list_zip(v, cen), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = (f"SELECT vec_id, v, c, dist FROM (SELECT vec_id, v, c, {dist} AS dist FROM kept, {{cents}}) "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY dist, c) = 1")
    parts = [f"""kept AS MATERIALIZED (SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dim})""",
             f"""c0 AS MATERIALIZED (SELECT ROW_NUMBER() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v AS cen
  FROM kept QUALIFY c < {k})"""]
    for i in range(rounds):
        parts.append(f"a{i} AS MATERIALIZED ({near.format(cents=f'c{i}')})")
        parts.append(f"""m{i} AS MATERIALIZED (SELECT c, list(m ORDER BY j) AS cen FROM (SELECT c, j,
  CAST(floor(CAST(SUM(x) AS DOUBLE) / COUNT(*)) AS BIGINT) AS m
  FROM (SELECT c, unnest(v) AS x, unnest(range({dim})) AS j FROM a{i}) GROUP BY c, j) GROUP BY c)""")
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c, COALESCE(m{i}.cen, c{i}.cen) AS cen FROM c{i} LEFT JOIN m{i} USING (c))")
    parts.append(f"final AS MATERIALIZED ({near.format(cents=f'c{rounds}')})")
    return f"""WITH {', '.join(parts)}
SELECT f.vec_id, CAST(f.c AS INTEGER) AS cluster, CAST(f.dist AS BIGINT) AS distance,
  CAST(SUM(f.dist) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(SUM(f.dist) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.cen, ',')) AS centroid_sha256
FROM final f JOIN c{rounds} USING (c)"""
