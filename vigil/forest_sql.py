"""DuckDB statements that rebuild the isolation forest for oracle checks.

Same draws, same sample, same growth rule and the same integer path sums as
`vigil.operators.iforest`, unrolled level by level as CTEs. Used only to
check the Spark jobs; nothing here runs on Spark.
"""

from __future__ import annotations

from vigil.functions.draws import sql_uniform
from vigil.operators.iforest import EULER_GAMMA, UNITS, ForestParams, max_depth, sql_c_factor


def _feat_case(prefix: str, features: list[str], sel: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {prefix}{f}" for i, f in enumerate(features))
    return f"(CASE {sel} {whens} END)"


def forest_ctes(src: str, features: list[str], p: ForestParams = ForestParams()) -> list[tuple[str, str]]:
    """CTEs over `src` (columns `_id` + features, complete rows only).

    Ends with f_nodes(tree, node, depth, size, is_leaf, feature, split, units),
    f_scores(_id, path_units, raw_score) and f_cut(n, t_units, cut_raw).
    """
    T, seed = p.trees, p.seed
    F = ", ".join(features)
    levels = max_depth(p.sample_size)
    ctes: list[tuple[str, str]] = []
    add = lambda name, sql: ctes.append((name, sql))
    add("f_n", f"SELECT count(*) AS n, least({p.sample_size}, count(*)) AS psi, "
               f"CAST(CASE WHEN least({p.sample_size}, count(*)) > 1 THEN ceil(log2(least({p.sample_size}, count(*)))) ELSE 0 END AS INTEGER) AS maxd FROM {src}")
    add("f_pa", f"SELECT s.*, row_number() OVER (ORDER BY md5('{seed}:' || CAST(_id AS VARCHAR)), _id) AS rk FROM {src} s")
    add("f_place", f"SELECT i.range AS place, psi, i.range % least(n, {T} * psi) AS rk0 FROM range({T * p.sample_size}) i, f_n WHERE i.range < {T} * psi")
    add("f_m0", f"SELECT CAST(place // psi AS INTEGER) AS tree, 1 AS node, _id, {F} FROM f_place JOIN f_pa ON rk - 1 = rk0")
    nk = len(features)
    for d in range(levels + 1):
        mins = ", ".join(f"min({f}) AS mn{i}, max({f}) AS mx{i}" for i, f in enumerate(features))
        add(f"f_st{d}", f"SELECT tree, node, count(*) AS size, {mins} FROM f_m{d} GROUP BY tree, node")
        var = ", ".join(f"CASE WHEN mx{i} > mn{i} THEN 1 ELSE 0 END AS var{i}" for i in range(nk))
        k = " + ".join(f"var{i}" for i in range(nk))
        uf = sql_uniform(str(seed), "tree", "node", "'f'")
        us = sql_uniform(str(seed), "tree", "node", "'s'")
        pick = " ".join(
            f"WHEN var{i} = 1 AND {(' + '.join(f'var{j}' for j in range(i)) or '0')} = idx THEN {i}" for i in range(nk))
        mn_sel = " ".join(f"WHEN {i} THEN mn{i}" for i in range(nk))
        mx_sel = " ".join(f"WHEN {i} THEN mx{i}" for i in range(nk))
        add(f"f_nd{d}", f"""
            SELECT tree, node, {d} AS depth, size, is_leaf,
                   CASE WHEN is_leaf THEN NULL ELSE feature END AS feature,
                   CASE WHEN is_leaf THEN NULL ELSE (CASE feature {mn_sel} END) + us * ((CASE feature {mx_sel} END) - (CASE feature {mn_sel} END)) END AS split,
                   CASE WHEN is_leaf THEN CAST(floor(({d} + {sql_c_factor('size')}) * {UNITS} + 0.5) AS BIGINT) END AS units
            FROM (SELECT *, CASE {pick} END AS feature
                  FROM (SELECT *, CAST(floor(uf * k) AS INTEGER) AS idx,
                               ({d} >= maxd OR size <= 1 OR k = 0) AS is_leaf
                        FROM (SELECT *, {k} AS k
                              FROM (SELECT st.*, {var}, f_n.maxd, {uf} AS uf, {us} AS us FROM f_st{d} st, f_n))))""")
        if d < levels:
            x = _feat_case("m.", features, "n.feature")
            add(f"f_m{d + 1}", f"""
                SELECT m.tree, 2 * m.node + CASE WHEN {x} >= n.split THEN 1 ELSE 0 END AS node, m._id, {', '.join('m.' + f for f in features)}
                FROM f_m{d} m JOIN f_nd{d} n ON m.tree = n.tree AND m.node = n.node WHERE NOT n.is_leaf""")
    add("f_nodes", " UNION ALL ".join(
        f"SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(depth AS INTEGER) AS depth, "
        f"CAST(size AS BIGINT) AS size, is_leaf, CAST(feature AS INTEGER) AS feature, split, units FROM f_nd{d}"
        for d in range(levels + 1)))
    add("f_p0", f"SELECT s._id, CAST(t.range AS INTEGER) AS tree, 1 AS node, {', '.join('s.' + f for f in features)} FROM {src} s CROSS JOIN range({T}) t")
    for d in range(levels + 1):
        add(f"f_j{d}", f"SELECT p.*, n.is_leaf, n.feature, n.split, n.units FROM f_p{d} p JOIN f_nodes n ON p.tree = n.tree AND p.node = n.node")
        if d < levels:
            x = _feat_case("", features, "feature")
            add(f"f_p{d + 1}", f"SELECT _id, tree, 2 * node + CASE WHEN {x} >= split THEN 1 ELSE 0 END AS node, {F} FROM f_j{d} WHERE NOT is_leaf")
    leaves = " UNION ALL ".join(f"SELECT _id, units FROM f_j{d} WHERE is_leaf" for d in range(levels + 1))
    add("f_units", f"SELECT _id, CAST(sum(units) AS BIGINT) AS path_units FROM ({leaves}) GROUP BY _id")
    add("f_scores", f"SELECT _id, path_units, -pow(2.0, -(path_units / ({UNITS} * {T})) / {sql_c_factor('psi')}) AS raw_score FROM f_units, f_n")
    return ctes


def cut_ctes(contamination: float, name: str = "f_cut", scores: str = "f_scores") -> list[tuple[str, str]]:
    """t_units: flagged iff path_units < t_units; cut_raw: interpolated percentile of raw_score."""
    c = f"CAST({contamination!r} AS DOUBLE)"
    return [
        (f"{name}_r", f"""SELECT n, CAST(floor({c} * (n - 1)) AS BIGINT) AS i, {c} * (n - 1) - floor({c} * (n - 1)) AS frac
                         FROM (SELECT count(*) AS n FROM {scores})"""),
        (f"{name}_o", f"SELECT path_units, raw_score, row_number() OVER (ORDER BY path_units) - 1 AS rk FROM {scores}"),
        (name, f"""SELECT r.n,
                      (SELECT path_units FROM {name}_o WHERE rk = CASE WHEN r.frac > 0 THEN least(r.i + 1, r.n - 1) ELSE r.i END) AS t_units,
                      (SELECT quantile_cont(raw_score, {c}) FROM {scores}) AS cut_raw
                   FROM {name}_r r"""),
    ]


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body


__all__ = ["forest_ctes", "cut_ctes", "with_ctes", "EULER_GAMMA"]
